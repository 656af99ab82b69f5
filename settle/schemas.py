"""Input schemas as DDL text, applied on read."""


def _schema(**fields: str) -> str:
    return ", ".join(f"`{n}` {t}" for n, t in fields.items())


TLM_FILE = (
    "`Settlement Date` string, `Settlement Run Type` string,"
    " `Settlement Period` int, `Zone` int, `Off Taking` double, `Delivering` double"
)

GCF_FILE = _schema(
    GSP_GROUP_ID="string", SETTLEMENT_DATE="string", SSR_RUN_TYPE="string",
    SETTLEMENT_PERIOD="double", GSP_GROUP_CORRECTION_FACTOR="double",
)

LLF_FILE = _schema(
    DISTRIBUTOR_BUSINESS_ID="string", MARKET_PARTICIPANT_ID="string",
    LLF_CLASS_ID="string", START_SETTLEMENT_DATE="string",
    END_SETTLEMENT_DATE="string", DAY_TYPE="string", VALUE="double",
    START_SETTLEMENT_PERIOD="bigint", END_SETTLEMENT_PERIOD="bigint",
)

PERIOD_COLUMNS = [f"ppc_{sp}" for sp in range(1, 51)]

PC_FILE = _schema(
    PROFILE_CLASS_ID="string", GSP_GROUP_ID="string",
    STD_SETTLEMENT_CONFIG_ID="string", TIME_PATTERN_REGIME_ID="string",
    SETTLEMENT_DATE="string", **{c.upper(): "double" for c in PERIOD_COLUMNS},
)

# One payload: units of a type on a day, with capacities by settlement period.
UNIT_PAYLOAD = (
    "settlementdate struct<_settlementdate: string, bmunit: array<struct<"
    "_bmunitid: string, settlementperiod: array<struct<"
    "_settlementperiod: int, _gc: double, _dc: double>>>>>"
)
