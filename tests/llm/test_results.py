"""Results of the operators against SQL, brute force, the library itself or held-out labels."""

import gzip
import hashlib
import json
import math
import random
import re
import time
from pathlib import Path

import duckdb
import numpy as np
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from settle.llm import bpe, decontaminate, html_text, language_id, nearest, personal, secrets, simhash, warc
from settle.llm import queries as registered
from settle.llm.common import store
from settle.llm.queries import multilingual, token_digests

FOLDER = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"
TABLES = ["documents", "pages", "benchmark", "embeddings", "labels", "conversations"]


def plain(value):
    return None if value is None or (isinstance(value, float) and math.isnan(value)) else value


@pytest.mark.parametrize("name", sorted(registered.ORACLES))
def test_query_matches_sql(corpus, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    got = registered.QUERIES[name](corpus, SMALL)
    columns = sorted(got.columns)
    rows = sorted(repr(tuple(plain(v) for v in r)) for r in got.select(*columns).collect())
    want = con.sql(f"SELECT {', '.join(columns)} FROM ({registered.ORACLES[name]})").fetchall()
    assert rows == sorted(repr(tuple(plain(v) for v in r)) for r in want)


@pytest.mark.parametrize("name", ["op2_quality", "op4_language_id"])
def test_held_out_accuracy(corpus, name):
    got = registered.QUERIES[name](corpus, FOLDER).toPandas()
    truth = corpus.read.parquet(f"{FOLDER}/{'labels' if name == 'op2_quality' else 'documents'}.parquet").toPandas()
    both = got[got.held_out].merge(truth, on="doc_id")
    right = both.predicted == both.quality if name == "op2_quality" else both.lang_pred == both.lang
    assert right.mean() > 0.95
    assert got.score.between(0, 1).all()


def test_language_codes_are_apart():
    for classes in (1, 2, 4, 7, 8, 40):
        code = language_id.codewords(classes)
        assert len({tuple(row) for row in code}) == classes


def slow_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_against_all_pairs(corpus, make):
    random_ = random.Random(3)
    base = [random_.choice("abcdefgh") * random_.randint(1, 3) for _ in range(400)]
    texts = [None, "", "one", "One two", *(" ".join(base[:n]) for n in range(1, 60)), " ".join(base)]
    for _ in range(150):
        copy = list(base)
        copy[random_.randrange(len(copy))] = "zz"
        texts.append(" ".join(copy))
    documents = store(make([(1000 - i, t) for i, t in enumerate(texts)]), "near")
    got = {r.doc_id: r for r in simhash.near_duplicates(documents).collect()}
    prints = {1000 - i: slow_fingerprint(t) for i, t in enumerate(texts)}
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    least = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= 2 and least[b] < least[a]:
                    least[a], changed = least[b], True
    assert {i: r.component_id for i, r in got.items()} == least
    kept = [r.doc_id for r in simhash.keep_one(documents).collect()]
    assert sorted(kept) == sorted(set(least.values()))


def plain_longest(text, items):
    """Longest run of words that a text shares with one item, by comparing all runs."""
    words = re.findall(r"[0-9a-z\x80-\U0010ffff]+", text.translate({i: i + 32 for i in range(65, 91)}))
    runs = {}
    for item_id, item in items:
        mine = re.findall(r"[0-9a-z\x80-\U0010ffff]+", item.translate({i: i + 32 for i in range(65, 91)}))
        for a in range(len(mine)):
            for b in range(a + 1, len(mine) + 1):
                run = tuple(mine[a:b])
                runs[run] = min(runs.get(run, str(item_id)), str(item_id))
    for n in range(len(words), 0, -1):
        for start in range(len(words) - n + 1):
            if tuple(words[start : start + n]) in runs:
                return n, start, runs[tuple(words[start : start + n])]
    return 0, None, None


@pytest.mark.parametrize("block_bytes", [2_000_000, 120])
def test_longest_matches(corpus, make, monkeypatch, block_bytes):
    draw = random.Random(8)
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", 3000)
    monkeypatch.setattr(decontaminate, "KEPT_BYTES", block_bytes)
    say = lambda n, alphabet: " ".join(draw.choice(alphabet) for _ in range(n))
    few, many = ["a", "b"], [f"w{i}" for i in range(30)]
    items = [(i, say(draw.randrange(0, 45), draw.choice([few, many]))) for i in range(50)] + [(9, "again the ninth"), (60, say(200, many))]
    texts = [say(draw.randrange(0, 90), draw.choice([few, many, many + ["unknown", "Other"]])) for _ in range(60)]
    for i in range(0, 40, 3):  # passages of items, some of them past 16 words and to the end of the text
        words = items[draw.choice([5, 7, 11, 51])][1].split()
        texts[i] += " " + " ".join(words[draw.randrange(0, 10) :])
    texts += [texts[0], items[51][1], None, "", "Again, the NINTH?"]
    found = decontaminate.findings(make(texts), corpus.createDataFrame(items, "item_id long, text string"), ["doc_id"])
    if block_bytes == 120:
        assert len(decontaminate.store_blocks(corpus.createDataFrame(items, "item_id long, text string")).collect()) >= 30
    for r in found.collect():
        want = plain_longest(texts[r.doc_id] or "", items)
        assert (r._match_longest, r._match_longest_start, r._match_longest_item) == want, r.doc_id


def test_windows_apart_are_no_longest_match(corpus, make):
    run = " ".join(f"a{i}" for i in range(12))
    benchmark = corpus.createDataFrame([(1, f"x {run} q z {run} y")], "item_id long, text string")
    row = decontaminate.findings(make([f"x {run} y"]), benchmark, ["doc_id"]).first()
    assert (row._match_longest, row._match_longest_start, row._match_longest_item) == (13, 0, "1")


def test_long_copies_of_an_item_end(corpus, make):
    passage = " ".join(f"v{i % 977}x{i % 13}" for i in range(20_000))
    benchmark = corpus.createDataFrame([(1, passage), (2, passage)], "item_id long, text string")
    start = time.time()
    rows = decontaminate.findings(make([passage, "intro " + passage, passage + " tail"]), benchmark, ["doc_id"]).orderBy("doc_id").collect()
    assert [(r._match_longest, r._match_longest_start, r._match_longest_item) for r in rows] == [(20_000, 0, "1"), (20_000, 1, "1"), (20_000, 0, "1")]
    assert time.time() - start < 60


def test_benchmark_is_not_in_the_driver_and_documents_are_read_once(corpus, make, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 50)
    benchmark = corpus.createDataFrame([(i, f"some item number {i} of many") for i in range(60)], "item_id long, text string")
    found = decontaminate.findings(store(make(["a b c"]), "once"), benchmark, ["doc_id"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_windows_over_several_blocks(corpus, make, monkeypatch):
    items = [(i, " ".join(f"w{i}x{j}" for j in range(20))) for i in range(6)]
    benchmark = corpus.createDataFrame([*items, (7, "short item")], "item_id long, text string")
    texts = [items[1][1], "a " + items[2][1].upper() + " b " + items[3][1], "no match at all", "a Short, item!", None]
    documents = store(make(texts), "blocks")
    whole = decontaminate.findings(documents, benchmark, ["doc_id"])
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 200)
    cut = decontaminate.findings(documents, benchmark, ["doc_id"])
    columns = ["doc_id", "_match_n_words", "_match_n_hit", "_match_items", "_match_longest", "_match_contaminated"]
    assert len(decontaminate.store_blocks(benchmark).collect()) == 6
    rows = sorted(map(tuple, cut.select(columns).collect()))
    assert rows == sorted(map(tuple, whole.select(columns).collect()))
    assert rows[0] == (0, 20, 20, ["1"], 20, True)
    assert rows[1] == (1, 42, 40, ["2", "3"], 20, True)
    assert rows[2] == (2, 4, 0, [], 0, False)
    assert rows[3] == (3, 3, 2, ["7"], 2, True)


def test_secrets_owned_and_copied(corpus, make):
    live, copied = "q9Zk27LmPxT4vB8w", "exampleexample12"
    parts = [make([(i, f"x token = '{copied}' y")], source=f"s{i}") for i in range(5)]
    documents = parts[0].union(parts[1]).union(parts[2]).union(parts[3]).union(parts[4])
    documents = documents.union(make([(9, f"é token={live}; secret=short; AKIA{'Z9' * 8} {'ab12' * 5}")], source="s9"))
    found = {r.doc_id: r for r in secrets.scan(documents, ["doc_id"]).collect()}
    assert [s.kind for s in found[0]._base] == ["assign"] and not found[0]._live and found[0]._n_copied == 1
    assert [(s.kind, s.start) for s in found[9]._base] == [("assign", 2), ("access", 40), ("hex", 61)]
    assert [(s.start, s.end) for s in found[9]._live] == [(8, 24)]
    masked = {r.doc_id: r.text for r in secrets.mask_live(documents).collect()}
    assert masked[9].startswith("é token=<secret>; secret=short;") and copied in masked[0]


def test_warc_copies(corpus, tmp_path):
    big, other = "é" * 600, "b" * 2000
    rows = [(1, "u1", big), (2, "u2", big), (3, None, big), (4, "u\r\n4", None), (5, "u5", "tiny"), (6, "u6", "tiny"),
            (7, "u7", other), (7, "u7", other), (None, "u", other), (8, "http://x/: y", "<p>" + "c" * 3_000_000)]
    corpus.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = registered.op6_warc(corpus, str(tmp_path)).collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = con.sql(registered.ORACLES["op6_warc"]).fetchall()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    index, folder = warc.archive(corpus.read.parquet(str(tmp_path / "pages.parquet")))
    read = {r.record_id: r for r in warc.read_records(index, folder).collect()}
    assert bytes(read["3"].payload).decode() == big and read["1"].refers_to == "3" and not read["1"].payload
    assert len(read["8"].payload) == 3_000_003


def test_warc_read_by_sidecars_alone(corpus, tmp_path):
    pages = corpus.createDataFrame([(i, f"u{i % 3}", "x" * (700 * (i % 3))) for i in range(60)], "page_id long, url string, html string")
    index, folder = warc.archive(pages)
    # What a lost attempt leaves behind is not in the list of finished files.
    store_, top = warc.open_store(folder)
    with store_.open_output_stream(f"{top}/lost.warc.gz.idx", compression=None) as out:
        out.write(b'{"record_id": "<urn:page:7>", "start": 0, "size": 9}\n')
    assert index.count() == 60
    found, profiles = {}, set()
    for sidecar in Path(folder.removeprefix("file:")).glob("*.idx"):
        if sidecar.name.startswith("lost"):
            continue
        archive = sidecar.with_suffix("").read_bytes()
        for line in sidecar.read_text().splitlines():
            place = json.loads(line)
            record = gzip.decompress(archive[place["start"] : place["start"] + place["size"]])
            ((headers, payload, _),) = warc.Reader(iter([record]))
            assert headers["WARC-Record-ID"] == place["record_id"]
            found[headers["WARC-Record-ID"]] = headers["WARC-Type"]
            profiles.add((headers["WARC-Type"], headers.get("WARC-Profile")))
    assert len(found) == 60 and list(found.values()).count("revisit") == 19
    assert profiles == {("response", None), ("revisit", warc.REVISIT_PROFILE)}
    corpus.createDataFrame([(p.path, p.start, p.size, "<urn:page:0>") for p in index.take(2)], warc.INDEX).createOrReplaceTempView("wrong")
    with pytest.raises(Exception, match="does not belong"):
        warc.read_records(corpus.table("wrong"), folder).collect()


def test_warc_payloads_in_small_batches(corpus, monkeypatch):
    pages = corpus.createDataFrame([(i, None, f"{i}" * 3000) for i in range(50)], "page_id long, url string, html string")
    index, folder = warc.archive(pages)
    monkeypatch.setattr(warc, "BATCH_BYTES", 5000)
    got = {r.record_id: bytes(r.payload).decode() for r in warc.read_records(index, folder).collect()}
    assert got == {str(i): f"{i}" * 3000 for i in range(50)}


def test_warc_of_no_pages(corpus):
    index, folder = warc.archive(corpus.createDataFrame([], "page_id long, url string, html string"))
    assert warc.read_records(index, folder).count() == 0


@pytest.mark.parametrize("cut", [1, 7, 1000])
def test_inflate_whatever_the_pieces(cut):
    import io

    data = b"".join(bytes([i % 251]) * i for i in range(900))
    whole = warc.gzip_member(data, 6) + warc.gzip_member(b"", 6) + warc.gzip_member(data[:500], 1)
    assert b"".join(warc.inflate(io.BytesIO(whole), cut)) == data + data[:500]
    with pytest.raises(ValueError):
        list(warc.inflate(io.BytesIO(warc.gzip_member(data, 6)[:-20]), cut))


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header>Site</header><nav><ul><li><a href="/">Home</a></ul></nav><div class="ad">Buy</div>%s
<div id="comments"><p>Nice read, thank you so much for this very long and thorough piece of text.</p></div>
<footer>&copy; 2020</footer></body></html>"""
BODY = """<h1>Title</h1><p>Short.<p>A &lt;longer&gt; para&shy;graph with <b>bold</b> and&nbsp;white
space in it, long enough to surge over the threshold.</p><script>var t="</p>";</script><p>End.</p>"""
TEXT = "Title\nShort.\nA <longer> para­graph with bold and white space in it, long enough to surge over the threshold.\nEnd."


@pytest.mark.parametrize("wrap", ["<article>%s</article>", "<div class='content'>%s</div>", "<main>%s</main>"])
def test_main_text(wrap):
    assert html_text.main_text(PAGE % (wrap % BODY)) == TEXT


def test_story_beside_teaser_articles():
    story = ["The story", *(f"Paragraph {i} of the story, told at such a length that it surges by itself, short as it is." for i in range(4))]
    cards = "".join(f"<article><h3><a href='/{i}'>Teaser {i} of another story</a></h3></article>" for i in range(6))
    told = f"<div><h1>{story[0]}</h1>{''.join(f'<p>{p}</p>' for p in story[1:])}</div>"
    for body in (cards + told, told + cards):
        assert html_text.main_text(f"<html><body>{body}</body></html>") == "\n".join(story)


def test_tag_excludes_no_text():
    parts = [f"Part {i} of a text that is long enough to surge over the threshold, wherever in the page it is." for i in range(3)]
    page = f"<body><p>{parts[0]}</p><article><h1>A</h1><p>B</p><p>C</p><p>{parts[1]}</p><p>{parts[1]}</p></article><p>{parts[2]}</p></body>"
    assert html_text.main_text(page) == "\n".join([parts[0], "A", "B", "C", parts[1], parts[1], parts[2]])
    page = f"<body><article><h1>A</h1><p>B</p><p>C</p><p>D</p><p>{parts[1]}</p><p>{parts[1]}</p></article></body>"
    assert html_text.main_text(page) == "\n".join(["A", "B", "C", "D", parts[1], parts[1]])


@pytest.mark.parametrize("before", [
    "<head><title>T</title>", "<head><meta charset='x'><title>T", "<title>T", "<body><noscript>", "<body><svg><path d=''>",
    "<body><select><option>A<option>B", "<body><object data='x'>", "<body><iframe src='x'>", "<body><svg><p>More</p><svg><title>x</title></svg>",
    "<head><title>T</title></head><svg><svg></svg>no</svg>", "<head><script>a</script ><style>b</style><template>c</template>",
])
def test_hidden_elements_without_end_tags(before):
    text = "Text of the page, which begins where no closing tag has ended the hidden element."
    got = html_text.main_text(f"<html>{before}<body><p>{text}</p></body></html>").split("\n")
    assert got == (["More", text] if "More" in before else [text])


def test_all_between_surge_and_dive_is_kept():
    parts = [f"Part {i} of a text that is long enough to surge over the threshold, wherever in the page it is." for i in range(2)]
    advert = "<div class='ad'><p>Buy</p><p>this</p><p>or</p><p>that</p></div>"
    page = f"<body><div><p>{parts[0]}</p><p>See <a href='/x'>the reference that is mostly a link</a></p><p>{parts[1]}</p>{advert}<p>End.</p></div></body>"
    assert html_text.main_text(page) == "\n".join([parts[0], "See the reference that is mostly a link", parts[1], "End."])


def test_main_text_of_odd_pages(corpus):
    odd = [None, "", "just text", "<p>unclosed <b", "<!-- open", "<script>x", "<p>" * 3000, "a &lt; b <br/> c", "<article></article>"]
    rows = corpus.createDataFrame([(i, h, "x") for i, h in enumerate(odd)], "page_id long, html string, text string")
    got = {r.page_id: r.text for r in html_text.extract(rows, ["page_id"]).collect()}
    assert got == {0: "", 1: "", 2: "just text", 3: "unclosed <b", 4: "", 5: "", 6: "", 7: "a < b c", 8: ""}


def test_recall(corpus):
    got = registered.op8_nearest(corpus, FOLDER).toPandas()
    rows = corpus.read.parquet(f"{FOLDER}/embeddings.parquet").toPandas().sort_values("vec_id")
    vectors, ids = np.stack(rows.embedding).astype(float), rows.vec_id.to_numpy()
    found = set(zip(got.query_id, got.vec_id, strict=True))
    want = set()
    for i in np.flatnonzero(ids % 20 == 0):
        score = vectors @ vectors[i]
        score[i] = -np.inf
        want |= {(ids[i], ids[j]) for j in np.lexsort((ids, -score))[:20]}
    assert len(want & found) / len(want) >= 0.9


def test_isolated_queries_get_all_they_are_due(corpus):
    random_ = np.random.default_rng(5)
    centres = np.repeat(random_.normal(size=(40, 32)), 60, axis=0)
    vectors = np.concatenate([centres + 0.01 * random_.normal(size=centres.shape), random_.normal(size=(20, 32))])
    table = corpus.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    isolated = range(2400, 2420)
    asked = (F.col("vec_id") >= 2400) | (F.col("vec_id") % 300 == 0)
    got = nearest.nearest(table, asked, 20, "vec_id", "embedding").toPandas()
    assert got.groupby("query_id")["rank"].apply(sorted).to_dict() == {
        i: list(range(1, 21)) for i in [*range(0, 2400, 300), *isolated]
    }
    near = vectors @ vectors[isolated].T
    near[isolated, range(20)] = -np.inf
    want = {(i, j) for i, column in zip(isolated, near.T, strict=True) for j in np.argsort(-column)[:20]}
    assert len(want & set(zip(got.query_id, got.id, strict=True))) / len(want) >= 0.9


def test_products_of_retrieved_pairs_only(monkeypatch):
    random_ = np.random.default_rng(6)
    vectors = np.repeat(random_.normal(size=(40, 32)), 50, axis=0) + 0.01 * random_.normal(size=(2000, 32))
    codes, ids, done = nearest.learn(vectors, 20), np.arange(2000), []
    products = nearest.inner_products
    monkeypatch.setattr(nearest, "inner_products", lambda one, other: done.append(len(one)) or products(one, other))
    query, found, score = nearest.search((ids[:300], vectors[:300]), (ids, vectors), codes, 21)
    bits = codes.encode(vectors)
    within = np.bitwise_count(bits[:300, None, :] ^ bits[None, :, :]).sum(2, dtype=int) <= codes.radius
    assert sum(done) == within.sum() < 0.1 * within.size
    near = np.where(within, vectors[:300] @ vectors.T, -np.inf)
    want = np.argsort(-near, axis=1)[:, :21]
    assert set(zip(query, found, strict=True)) == {(i, j) for i in range(300) for j in want[i] if within[i, j]}


def test_equal_and_unusable_vectors(corpus):
    same = [1.0, 0.0]
    rows = [(i, same) for i in range(0, 60)] + [(100, [0.9, 0.1]), (101, None), (102, [0.0, 0.0]), (103, [1.0, None]),
            (104, [float("nan"), 1.0]), (105, [1.0]), (None, same), (106, [2.0, 0.0]), (0, same), (7, [5.0, 5.0])]
    table = corpus.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = nearest.nearest(table, F.col("vec_id") % 20 == 0, 5, "vec_id", "embedding").collect()
    by = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        by.setdefault(r.query_id, []).append((r.id, r.score))
    # Two rows have the id 0 and each is a query; (105, [1.0]) counts as [1.0, 0.0]; the two rows of id 7 both are candidates.
    assert set(by) == {0, 20, 40, 100}
    assert sorted(by[0]) == sorted(2 * [(7, 5.0), (106, 2.0), (0, 1.0), (1, 1.0), (2, 1.0)])
    assert by[20] == [(7, 5.0), (106, 2.0), (0, 1.0), (0, 1.0), (1, 1.0)]
    assert [r[0] for r in by[100]][:2] == [7, 106]


def test_no_row_is_left_out(corpus):
    random_ = random.Random(8)
    rows = [(random_.randint(0, 60), [random_.choice([-1.0, 0.5, 2.0]) for _ in range(random_.randint(1, 6))]) for _ in range(300)]
    table = corpus.createDataFrame(rows, "vec_id long, embedding array<double>")
    # All rows are due, so the search goes on until it has every one.
    got = nearest.nearest(table, F.col("vec_id") % 20 == 0, 400, "vec_id", "embedding").collect()
    want = []
    for i, (query, one) in enumerate(rows):
        if query % 20 == 0:
            scores = [(sum(a * b for a, b in zip(one, v, strict=False)), c) for j, (c, v) in enumerate(rows) if j != i]
            want += [(query, rank, c, s) for rank, (s, c) in enumerate(sorted(scores, key=lambda r: (-r[0], r[1])), 1)]
    assert sorted((r.query_id, r.rank, r.id, r.score) for r in got) == sorted(want)


def test_few_vectors(corpus):
    for rows in ([], [(0, [1.0, 2.0])], [(1, [1.0, 2.0])], [(0, [1.0, 2.0]), (1, [0.5, 1.0])]):
        table = corpus.createDataFrame(rows, "vec_id long, embedding array<float>")
        got = nearest.nearest(table, F.col("vec_id") % 20 == 0, 5, "vec_id", "embedding").collect()
        assert [(r.query_id, r.rank, r.id, r.score) for r in got] == ([(0, 1, 1, 2.5)] if len(rows) == 2 else [])


def test_bpe_as_the_library_does(corpus, make):
    random_ = random.Random(2)
    odd = [None, "", " ", "  ", "a  b", "  a", " \n a", "x \x1c y", "it's  don't 'S ' s", "　a", "a \t\tb \n", "日本語 テキスト。 次"]
    odd += ["".join(random_.choice(" \n\t'sabé1.! \x1cßλ日😀 ") for _ in range(random_.randint(0, 60))) for _ in range(500)]
    vocabulary = multilingual()
    library = tiktoken.Encoding("own", pat_str=vocabulary.pattern, mergeable_ranks=vocabulary.ranks, special_tokens={})
    got = {r.doc_id: r for r in token_digests(bpe.encode(store(make(odd), "odd"), vocabulary, ["doc_id"]), vocabulary).collect()}
    for i, text in enumerate(odd):
        ids = library.encode_ordinary(text or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_packed_numbers():
    numbers = np.array([0, 1, 127, 128, 16383, 16384, 2**21, 2**28, 2**31], dtype=np.int64)
    parts = bpe.packed(numbers, np.array([0, 3, 3, 9]))
    back, bounds = bpe.unpacked(parts)
    assert back.tolist() == numbers.tolist() and bounds.tolist() == [0, 3, 3, 9]
    assert bpe.unpacked([])[0].tolist() == []


def base_personal(text):
    digits = re.compile(r"[^0-9]")
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
              if all(int(x) <= 255 for x in m.group().split("."))]
    found += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
              if 13 <= len(d := digits.sub("", m.group())) <= 19 and personal.luhn(d)]
    return found + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
                    if 9 <= len(digits.sub("", m.group())) <= 15]


def test_personal_against_patterns(corpus):
    random_ = random.Random(1)
    texts = [r.text for r in corpus.read.parquet(f"{FOLDER}/documents.parquet").select("text").collect()]
    for alphabet in ["a1@. -", "0123.+ -()", "12.@+%-a\n", "4111 -", "+123456789() .-", "a@b.c@d"]:
        texts += ["".join(random_.choice(alphabet) for _ in range(random_.randint(0, 40))) for _ in range(3000)]
    for text in texts:
        assert [s for s in personal.spans(text) if s[0] in personal.BASE] == base_personal(text)


def test_personal_cues():
    text = "iban DE89 3704 0044 0532 0130 00 END ssn: 123-45-6789 http://joe:pw@host.com/x"
    assert [s for s in personal.spans(text) if s[0] in personal.ADDED] == [("iban", 5, 32), ("account", 42, 53), ("login", 61, 67)]


@pytest.mark.parametrize("number", ["1" * 33, "1" * 5000, "1234 5678 " * 8 + "9", "123-456", "1" + " " * 40 + "23456"])
def test_number_after_cue_to_its_end(number):
    text = f"account: {number} x"
    assert [s for s in personal.spans(text) if s[0] == "account"] == [("account", 9, 9 + len(number))]
    assert not [s for s in personal.spans("account: 12-345 x") if s[0] == "account"]


def test_address_of_many_zeros():
    text = f"{'0' * 5000}.1.{'0' * 5000}7.255"
    assert [s for s in personal.spans(text) if s[0] == "ip"] == [("ip", 0, len(text))]
