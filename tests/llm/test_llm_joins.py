"""Operators with shuffles, each against brute force: winnowing, WARC, URL
filter, near-duplicates, top-k, and the pipeline."""

import hashlib
import io
import math
import random
import re
import struct
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from skytiles.llm import (common, decontaminate, language, neardup, secrets, topk, urlfilter,
                          warc)

SF = "/root/testdata/sf0.001"


def rows(spark, values, schema):
    return spark.createDataFrame(values, schema)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# --------------------------------------------------------------- winnowing

def brute_contamination(docs, items):
    pattern = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    coded = [(i, pattern.findall(lower(t))) for i, t in items]
    out = []
    for doc, text in docs:
        w, hit, found = pattern.findall(lower(text)), set(), set()
        for item, v in coded:
            n = min(10, len(v))
            for k in range(len(v) - n + 1 if n else 0):
                for at in range(len(w) - n + 1):
                    if w[at:at + n] == v[k:k + n]:
                        hit |= set(range(at, at + n))
                        found.add(item)
        out.append((doc, len(w), len(hit), sorted(str(x) for x in found if x is not None)))
    return out


def contamination_case():
    rnd = random.Random(6)
    vocab = ["a", "b", "éa", "C", "x1", "dd"]

    def text(n):
        return rnd.choice([" ", ", ", "-"]).join(rnd.choice(vocab) for _ in range(n))

    items = [(i, text(rnd.choice([1, 2, 4, 5, 7, 9, 10, 11, 14, 25]))) for i in range(14)]
    items += [(50, None), (51, ""), (52, "...!"), (3, text(13)), (None, text(12))]
    docs = []
    for i in range(60):
        own = text(rnd.randint(0, 40))
        if rnd.random() < 0.6:
            v = (rnd.choice(items)[1] or "").split(" ")
            own += " Zz " + " ".join(v[rnd.randint(0, 2):][:rnd.randint(1, 20)]) + " Yy " + text(4)
        docs.append((i, own))
    docs += [(70, None), (71, ""), (72, "!!"), (7, docs[3][1])]
    return docs, items


def test_contamination_equals_brute_force(spark):
    docs, items = contamination_case()
    d = rows(spark, docs, "doc_id int, text string").withColumn("n_hit", F.lit("other"))
    b = rows(spark, items, "item_id int, text string")
    got = [(r["doc_id"], r["n_words"], r["n_hit"], r["item_ids"])
           for r in decontaminate.contamination(d.repartition(3), b).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, brute_contamination(docs, items)))
    left = decontaminate.drop_contaminated(d, b)
    assert left.columns == d.columns
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(
        x[0] for x in brute_contamination(docs, items) if not x[2])


def test_contamination_empty_tables(spark):
    d = rows(spark, [(1, "a b c")], "doc_id int, text string")
    b = rows(spark, [(1, "a b c")], "item_id int, text string")
    assert decontaminate.contamination(d.limit(0), b).count() == 0
    assert [r["n_hit"] for r in decontaminate.contamination(d, b.limit(0)).collect()] == [0]
    assert [r["n_hit"] for r in decontaminate.contamination(d, b).collect()] == [3]


def test_winnowing_keeps_a_hash_of_every_span():
    rnd = np.random.default_rng(1)
    hashes = rnd.integers(0, 3, 400).astype(np.uint64)      # many equal hashes
    counts = np.array([150, 0, 9, 241])
    kept = decontaminate.fingerprints(hashes, counts, 10, 5)
    ends = np.cumsum(counts)
    for start, end in ((0, 150), (159, 400)):
        for s in range(start, end - 9):
            assert ((kept >= s) & (kept <= s + 5)).any()
    assert not ((kept >= ends[1]) & (kept < ends[2])).any()


def test_word_hashes_across_pieces(monkeypatch):
    text = "Éa bc  d\x00e " * 300
    table = common.word_table(lambda b: b > 0x20)
    data, offsets = np.frombuffer((text + "bcbc").encode(), np.uint8), None
    offsets = np.array([0, len(text.encode()) - 1, len(data)])
    whole = common.word_hashes(data, offsets, table)
    monkeypatch.setattr(common, "PIECE_BYTES", 7)
    for a, b in zip(whole, common.word_hashes(data, offsets, table)):
        assert (a == b).all()


# -------------------------------------------------------------------- WARC

PAGES = [(5, "http://a/%0A\n%", "x" * 200), (3, None, "x" * 200), (9, "http://b", "x" * 200),
         (1, "http://c", None), (2, "http://d", ""), (4, "http://e", "é" * 49),
         (6, "http://f", "é" * 49), (7, "http://g", "é" * 50), (8, "http://h", "é" * 50),
         (10, "http://i", "\r\n\r\nWARC/1.1\r\n"), (3, "http://j", "x" * 200),
         (None, "http://k", "x" * 200), (None, "http://l", "y" * 300), (None, "m", "y" * 300)]


def test_warc_round_trip(spark, tmp_path):
    pages = rows(spark, PAGES, "page_id bigint, url string, html string") \
        .withColumn("digest", F.lit("other"))
    manifest = warc.archive_pages(pages.repartition(3), f"file://{tmp_path}/w")
    got = warc.read_archives(manifest).collect()
    first = {"x" * 200: 3, "é" * 50: 7}
    want = []
    for page_id, url, html in PAGES:
        body = (html or "").encode()
        to = first.get(html)
        to = None if to == page_id else to
        want.append((page_id, url, len(body), hashlib.sha256(body).hexdigest(),
                     "revisit" if to else "response", to, None if to else body))
    assert sorted(map(repr, want)) == sorted(
        repr(tuple(bytes(x) if isinstance(x, bytearray) else x for x in r)) for r in got)
    with pytest.raises(Exception, match="already exists"):
        warc.archive_pages(pages, f"file://{tmp_path}/w")
    assert warc.read_archives(warc.archive_pages(pages.limit(0))).count() == 0


def test_warc_frames(tmp_path):
    """The dictionary leads, and every record is a frame of its own."""
    records = [warc._record(i, f"http://h/{i}", b"<p>" + bytes([65 + i % 26]) * 400, "0" * 64, None)
               for i in range(3000)]
    path = tmp_path / "a.warc.zst"
    writer = warc.ArchiveWriter(open(path, "wb"))
    for r in records:
        writer.add(r)
    writer.close()
    raw = path.read_bytes()
    magic, size = struct.unpack("<II", raw[:8])
    assert magic == warc.DICT_FRAME
    dictionary = zstandard.ZstdCompressionDict(raw[8:8 + size])
    assert dictionary.dict_id() and len(raw) < sum(map(len, records)) / 3
    at, out = 8 + size, []
    while at < len(raw):
        frame = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
        out.append(frame.decompress(raw[at:]))
        at = len(raw) - len(frame.unused_data)
    assert out == records
    assert len(list(warc.read_records(io.BytesIO(raw)))) == len(records)


# -------------------------------------------------------------- URL filter

def brute_rule(url):
    url = url or ""
    rest = url[url.index("://") + 3:] if "://" in url else ""
    host = re.split(r"[/?#]", rest)[0]
    path = re.split(r"[?#]", rest[len(host):])[0]
    host = lower(host)
    best = None
    for verdict, h, p in urlfilter.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            if best is None or len(h + p) > len(best[0]):
                best = (h + p, verdict)
    return host, path, best


URLS = [None, "", "no scheme", "http://", "http://ORG/x", "http://a.ORG", "http://a.org/",
        "http://example.org/es/1?x=/", "http://x.example.org/en/12", "http://notexample.org/en/12",
        "https://b.com/de/#/fr/", "https://b.com/fr/", "https://b.com?/fr/", "https://b.com/en/",
        "http://b.net/a/b\nc", "http://é.org/É", "x://y://z.org/", "http://u@b.com/de/1"]


def test_urls(spark):
    many = URLS * 3 + [f"http://h{i}.example.org/es/{i}" for i in range(40)] + \
        [f"http://h{i}.other.org/en/{i}" for i in range(40)]
    pages = rows(spark, list(enumerate(many)), "page_id int, url string") \
        .withColumn("ratio", F.lit("other"))
    got = {r["page_id"]: r for r in urlfilter.judge_urls(pages).collect()}
    assert len(got) == len(many)
    for i, url in enumerate(many):
        host, path, best = brute_rule(url)
        assert (got[i]["host"], got[i]["path"]) == (host, path)
        assert got[i]["rule"] == (best[0] if best else None)
        assert got[i]["verdict"] in ("allow", "block") and (
            not best or got[i]["verdict"] == best[1])
    assert urlfilter.judge_urls(pages.limit(0)).count() == 0
    alone = urlfilter.judge_urls(pages.where("url like '%.net/%'")).collect()
    assert {r["verdict"] for r in alone} == {"allow"}


def test_url_ratio_equals_brute_force(spark):
    good, bad = ["http://abc/x", "http://abd/y", "http://abc/x"], ["http://zzz/1"]
    texts = rows(spark, [(t, True) for t in good] + [(t, False) for t in bad],
                 "url string, accepted boolean").withColumn(
                     "framed", urlfilter._framed(F.col("url")))
    asked = rows(spark, [(u,) for u in ["http://abc/x", "zz", "", None]], "url string") \
        .withColumn("framed", urlfilter._framed(F.col("url")))
    got = {r["url"]: r["ratio"] for r in urlfilter.with_ratio(
        asked, urlfilter.string_counts(texts.select("framed", "accepted"))).collect()}

    def frame(u):
        return "\x02" * urlfilter.ORDER + (u or "") + "\x03"

    def counts(own):
        c = defaultdict(int)
        for u in own:
            t = frame(u)
            for i in range(urlfilter.ORDER, len(t)):
                for n in range(urlfilter.ORDER + 1):
                    c["c", t[i - n:i]] += 1
                    c["t", t[i - n:i + 1]] += 1
        return c

    def log_p(c, t, i):
        p = 1 / urlfilter.ALPHABET
        for n in range(urlfilter.ORDER + 1):
            p = (c["t", t[i - n:i + 1]] + urlfilter.STRENGTH * p) \
                / (c["c", t[i - n:i]] + urlfilter.STRENGTH)
        return math.log(p)

    a, r = counts(good), counts(bad)
    for u, ratio in got.items():
        t = frame(u)
        places = range(urlfilter.ORDER, len(t))
        want = sum(log_p(a, t, i) - log_p(r, t, i) for i in places) / len(places)
        assert ratio == pytest.approx(want, abs=1e-9)


def test_url_threshold_follows_the_range_of_the_ratios(spark):
    """Ratios far beyond any fixed range are separated too; equal cuts go to
    the one nearest to no difference."""
    for good, bad, low, high in [([30.0, 31.5, 42.0], [-9.0, 12.0, 29.0], 29.0, 30.0),
                                 ([-40.0, -41.0], [-90.0, -60.0], -60.0, -40.0),
                                 ([2.0, 9.0], [-9.0, -2.0], -0.1, 0.1)]:
        scored = rows(spark, [(x, True) for x in good] + [(x, False) for x in bad],
                      "ratio double, accepted boolean")
        assert low < urlfilter.threshold(scored) <= high
    one = rows(spark, [(5.0, True), (5.0, False)], "ratio double, accepted boolean")
    assert urlfilter.threshold(one) in (5.0, 405.0)
    assert urlfilter.threshold(one.where("accepted")) == float("-inf")
    assert urlfilter.threshold(one.limit(0)) == float("-inf")


def test_url_counts_grow_with_the_input(spark):
    rnd = random.Random(17)
    known = [(f"http://a.org/{''.join(rnd.choices('abcdefghijklmnopqrstuvwxyz0123456789', k=24))}",
              rnd.random() < 0.5) for _ in range(6000)]
    counts = {True: Counter(), False: Counter()}
    for u, accepted in known:
        t = "\x02" * urlfilter.ORDER + u + "\x03"
        counts[accepted].update((k, t[i - n:i + k]) for i in range(urlfilter.ORDER, len(t))
                                for n in range(urlfilter.ORDER + 1) for k in (0, 1))
    assert len(counts[True] | counts[False]) > 1 << 17
    asked = [u for u, _ in known[:200]] + [f"http://b.net/{i}" for i in range(100)]
    frame = urlfilter._framed(F.col("url"))
    table = urlfilter.string_counts(rows(spark, known, "url string, accepted boolean").select(
        frame.alias("framed"), "accepted"))
    got = {r["url"]: r["ratio"] for r in urlfilter.with_ratio(
        rows(spark, [(u,) for u in asked], "url string").withColumn("framed", frame),
        table).collect()}
    for u in asked:
        t, want = "\x02" * urlfilter.ORDER + u + "\x03", 0.0
        for c, sign in ((counts[True], 1), (counts[False], -1)):
            for i in range(urlfilter.ORDER, len(t)):
                p = 1 / urlfilter.ALPHABET
                for n in range(urlfilter.ORDER + 1):
                    p = (c[1, t[i - n:i + 1]] + urlfilter.STRENGTH * p) \
                        / (c[0, t[i - n:i]] + urlfilter.STRENGTH)
                want += sign * math.log(p)
        assert got[u] == pytest.approx(want / (len(t) - urlfilter.ORDER), abs=1e-9)


# --------------------------------------------------------- near-duplicates

def brute_groups(docs, shingle, percent=80):
    sets = []
    for _, text in docs:
        w = [x for x in re.split("[\x20\x09-\x0d]+", lower(text)) if x]
        n = min(shingle, len(w))
        sets.append({tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if n else set())
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            k = len(a & b)
            same = docs[i][0] == docs[j][0]
            if a and b and None not in (docs[i][0], docs[j][0]) and (
                    same or 100 * k >= percent * (len(a) + len(b) - k)):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return [(doc, len(sets[i]), least.get(find(i)) if doc is not None else None,
             doc is None or doc == least[find(i)]) for i, (doc, _) in enumerate(docs)]


def near_case():
    rnd = random.Random(12)

    def words(n):
        return [f"w{rnd.randrange(4000)}" for _ in range(n)]

    docs = []
    for family in range(25):
        base = words(rnd.choice([3, 6, 40, 120, 300]))
        for _ in range(rnd.choice([1, 2, 3, 8])):
            own = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2, 4])):
                own[rnd.randrange(len(own))] = f"v{rnd.randrange(4000)}"
            docs.append(rnd.choice([" ", "\n", "\t "]).join(own))
    # A chain: each is near to the next alone; and one large group of copies.
    base = words(200)
    for k in range(12):
        docs.append(" ".join(words(0) + [f"c{j}" for j in range(5 * k, 200 + 5 * k)]))
    hot = words(100)
    for k in range(60):
        own = list(hot)
        own[k % 100] = f"h{k}"
        docs.append(" ".join(own))
    docs += [" ".join(hot).upper()] * 20 + ["", None, "   ", "one", "ONE", "one two"]
    rnd.shuffle(docs)
    return list(enumerate(docs, 100))


@pytest.mark.parametrize("shingle", [4, 5])
def test_near_duplicates_equal_brute_force(spark, shingle):
    docs = near_case()
    d = rows(spark, docs, "doc_id bigint, text string").withColumn("kept", F.lit(1))
    got = [tuple(r) for r in neardup.near_duplicates(d.repartition(4), shingle=shingle).collect()]
    assert sorted(got) == sorted(brute_groups(docs, shingle))
    left = neardup.drop_near_duplicates(d, shingle=shingle)
    assert left.columns == d.columns
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(
        x[0] for x in brute_groups(docs, shingle) if x[3])


def test_near_duplicates_cases(spark):
    same = " ".join(f"a{k}" for k in range(30))
    other = " ".join(f"b{k}" for k in range(30))
    docs = [(5, same), (5, same), (3, other), (5, other), (None, same), (None, same), (9, None)]
    d = rows(spark, docs, "doc_id bigint, text string")
    got = [tuple(r) for r in neardup.near_duplicates(d).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, brute_groups(docs, 5)))
    # As a stage, rows that repeat an id are apart unless their texts are alike.
    left = [tuple(r) for r in neardup.drop_near_duplicates(d).collect()]
    assert sorted(map(repr, left)) == sorted(map(repr, [
        (3, other), (5, same), (None, same), (None, same), (9, None)]))
    assert neardup.near_duplicates(d.limit(0)).count() == 0
    assert neardup.drop_near_duplicates(d.limit(0)).count() == 0


def test_near_duplicate_stage_with_clashing_columns(spark):
    same = " ".join(f"a{k}" for k in range(30))
    names = ["row", "ROW_", "__nth", "id", "component", "doc", "key_id", "slot", "n", "kept"]
    docs = rows(spark, [(2, same, *range(10)), (1, same, *range(10)), (3, "b", *range(10))],
                "doc_id bigint, text string, " + ", ".join(
                    f"`{n}` int" for n in names)).drop("ROW_")
    left = neardup.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [1, 3]


def test_rows_without_keys(spark):
    df = rows(spark, [(k, f"t{k % 50}") for k in range(400)], "key_a bigint, slot string")
    gone = rows(spark, [(f"t{k}", k) for k in range(0, 50, 3)] * 2, "a string, b int")
    want = sorted(k for k in range(400) if k % 50 % 3)
    for most in (100, 0):               # broadcast, and by bitmap and shuffle
        left = common.without_keys(df, {"a": F.col("slot")}, gone, most)
        assert left.columns == df.columns
        assert sorted(r["key_a"] for r in left.collect()) == want
    assert common.without_keys(df, {"a": F.col("slot")}, gone.limit(0)).count() == 400


def test_components_of_a_chain(spark):
    edges = [(k, k + 1) for k in range(1, 60)] + [(100, 90), (90, 95), (7, 7)]
    got = dict(tuple(r) for r in neardup.components(
        rows(spark, edges, "u bigint, v bigint")).collect())
    assert got == {**{k: 1 for k in range(1, 61)}, 90: 90, 95: 90, 100: 90}


# ------------------------------------------------------------------- top-k

def brute_top(vectors, k, step):
    def usable(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    coded = [(n, i, [math.floor(256 * x) for x in v])
             for n, (i, v) in enumerate(vectors) if usable(v)]
    out = []
    for n, i, v in coded:
        if i % step == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), j) for m, j, w in coded
                            if m != n and len(w) == len(v))
            out += [(i, r, j, -s) for r, (s, j) in enumerate(scored[:k], 1)]
    return out


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_BYTES", 8 * 6 * 40)
    monkeypatch.setattr(topk, "QUERY_BYTES", 8 * 6 * 10)
    monkeypatch.setattr(topk, "WAVE_BYTES", 8 * 6 * 30)             # several waves
    rnd = np.random.default_rng(5)
    vectors = [(i, (rnd.normal(size=6) * rnd.choice([0.1, 1, 5])).tolist()) for i in range(300)]
    vectors += [(i, [0.5] * 6) for i in range(300, 320)]            # ties
    vectors += [(320, None), (330, [1.0, None] + [0.0] * 4), (340, [float("nan")] * 6),
                (350, [float("inf")] + [0.0] * 5), (10, [2.0] * 6), (400, [1.0, 2.0]),
                (401, [1.0, -2.0]), (410, [3.0]), (420, [1e12] * 6)]
    d = rows(spark, vectors, "vec_id bigint, embedding array<double>") \
        .withColumn("score", F.lit("other"))
    got = [tuple(r) for r in topk.top_k(d.repartition(3), F.col("id") % 10 == 0).collect()]
    assert sorted(got) == sorted(brute_top(vectors, 5, 10))
    assert topk.top_k(d.limit(0), F.col("id") % 10 == 0).count() == 0
    assert topk.top_k(d, F.col("id") < 0).count() == 0


def test_top_k_prunes_clustered_vectors(spark, monkeypatch):
    """Few pairs get an exact product, and the rows are those of brute force;
    vectors that are too short are not met at all."""
    monkeypatch.setattr(topk, "BLOCK_BYTES", 8 * 32 * 100)
    rnd = np.random.default_rng(8)
    centres = rnd.normal(size=(12, 24))
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    for spread, noise, step, least, most in ((0.05, 0.2, 25, 20_000, 90_000),
                                            (0.6, 0.02, 30, 0, 5_000)):
        vectors = [(i, (4 * centres[i % 12] * rnd.uniform(1 - spread, 1 + spread)
                        + rnd.normal(size=24) * noise).tolist()) for i in range(1500)]
        told = {}
        got = topk.top_k(rows(spark, vectors, "vec_id bigint, embedding array<double>"),
                         F.col("id") % step == 0, report=told).collect()
        assert sorted(map(tuple, got)) == sorted(brute_top(vectors, 5, step))
        assert least <= told["pairs"] <= most and told["exact"] <= 0.1 * told["pairs"]


def test_top_k_memory_does_not_grow_as_dimensions_shrink():
    rnd = np.random.default_rng(2)
    peaks = {}
    for dim in (2, 16, 64, 256):
        def block(budget, dim=dim):
            n = budget // (8 * (dim + topk.ROW_WORDS))
            v = np.floor(rnd.normal(size=(n, dim)) * 256).astype("<i8")
            ids = np.arange(n, dtype="<i8").tobytes()
            return {"dim": dim, "uids": ids, "ids": ids, "vectors": v.tobytes()}
        asked, other = block(topk.QUERY_BYTES // 8), block(topk.BLOCK_BYTES)
        wanted = topk.Wanted(asked, np.eye(dim), 5)
        candidates = topk.Block(other["uids"], other["ids"], other["vectors"], dim, np.eye(dim))
        tracemalloc.start()
        wanted.meet(candidates, [0, 0])
        peaks[dim] = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert len(wanted.best[0]) == 5 * len(wanted.least)
    assert max(peaks.values()) < 160 << 20, peaks


def test_top_k_of_a_block_is_exact_beyond_doubles():
    """Products too long for a double are taken in whole numbers."""
    v = np.array([[1 << 30, 1], [1 << 30, 0], [1 << 30, 2]], "<i8")
    ids = np.arange(3, dtype="<i8").tobytes()
    row = {"dim": 2, "uids": ids, "ids": ids, "vectors": v.tobytes()}
    wanted = topk.Wanted(row, np.eye(2), 2)
    wanted.meet(topk.Block(ids, ids, v.tobytes(), 2, np.eye(2)), [0, 0])
    got = list(zip(*[x.tolist() for x in wanted.best]))
    assert got == [(0, (1 << 60) + 2, 2, 2), (0, 1 << 60, 1, 1), (1, 1 << 60, 0, 0),
                   (1, 1 << 60, 2, 2), (2, (1 << 60) + 2, 0, 0), (2, 1 << 60, 1, 1)]


# -------------------------------------------- very long texts, empty tables

def test_very_long_texts(spark, tmp_path):
    """Megabytes in one row are handled whole: what matters is at the end."""
    rnd = random.Random(23)
    words = [f"w{rnd.randrange(10 ** 6)}" for _ in range(200_000)]
    item = " ".join(f"bench{k}" for k in range(10))
    long_text = " ".join(words) + " " + item
    edited = " ".join(w if k % 1000 else "other" for k, w in enumerate(words)) + " " + item
    docs = rows(spark, [(1, long_text), (2, edited), (3, "short")], "doc_id bigint, text string")
    items = rows(spark, [("7", item)], "item_id string, text string")
    hits = {r["id"]: r["n_hit"] for r in
            decontaminate.contamination(docs, items).withColumnRenamed("doc_id", "id").collect()}
    assert hits == {1: 10, 2: 10, 3: 0}
    groups = {r["id"]: r["component"] for r in neardup.near_duplicates(docs).collect()}
    assert groups == {1: 1, 2: 1, 3: 3}

    secret = long_text + " password=Zq81kLm2vXw0 "
    (spans,) = [r["spans"] for r in secrets.secret_spans(
        rows(spark, [(1, secret)], "doc_id bigint, text string")).collect()]
    assert {(s["kind"], secret[s["start"]:s["end"]]) for s in spans if s["kind"] != "hex"} == {
        ("assign", "password=Zq81kLm2vXw0"), ("guess", "Zq81kLm2vXw0")}

    pages = rows(spark, [(1, "u", long_text), (2, "v", long_text), (3, "w", edited)],
                 "page_id bigint, url string, html string")
    back = {r["page_id"]: r for r in warc.read_archives(
        warc.archive_pages(pages, f"file://{tmp_path}/long")).collect()}
    assert [back[k]["record_type"] for k in (1, 2, 3)] == ["response", "revisit", "response"]
    assert back[2]["payload_digest"] == hashlib.sha256(long_text.encode()).hexdigest()

    address = "http://a.org/" + "".join(rnd.choices("abcdef", k=100_000))
    known = [(k, f"http://a.org/{k}") for k in range(40)] + [
        (100 + k, f"http://b.com/de/{k}") for k in range(40)]
    judged = {r["page_id"]: r for r in urlfilter.judge_urls(rows(
        spark, [*known, (999, address), (1000, address.replace("a.org", "a.net"))],
        "page_id bigint, url string")).collect()}
    assert judged[999]["rule"] == "org/" and len(judged[999]["path"]) == 100_001
    assert judged[1000]["rule"] is None and math.isfinite(judged[1000]["ratio"])


def test_empty_tables(spark):
    docs = rows(spark, [], "doc_id bigint, text string, spans string, id string")
    assert secrets.secret_spans(docs).count() == 0
    assert secrets.mask_secrets(docs).columns == docs.columns
    assert urlfilter.judge_urls(rows(spark, [], "page_id bigint, url string, host int")).count() == 0
    assert neardup.near_duplicates(docs.drop("id")).count() == 0


# ---------------------------------------------------------------- pipeline

def test_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF).collect()}
    model = language.train(language.labelled_sample(docs))
    known = [r["doc_id"] for r in language.predict_languages(docs, model).collect()
             if not r["rejected"]]
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    left = [(i, texts[i]) for i in known]
    left = [(i, texts[i]) for i, _, _, kept in brute_groups(left, 5) if kept]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet")
             .select("item_id", "text").collect()]
    # An item window that a document holds, by plain text search.
    pattern = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = set()
    for _, t in items:
        w = pattern.findall(lower(t))
        windows |= {tuple(w[k:k + 10]) for k in range(len(w) - 9)}
    kept = {}
    for i, t in left:
        w = pattern.findall(lower(t))
        if not any(tuple(w[k:k + 10]) in windows for k in range(len(w) - 9)):
            kept[i] = secrets.mask_spans(t, secrets.find_spans(t))
    assert set(got) == set(kept) and len(kept) < len(texts)
    for i, text in kept.items():
        assert got[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_pipeline_stages_keep_columns(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    long = " ".join(f"word{k}" for k in range(20))
    docs = rows(spark, [(1, long, "en", "s", 9), (2, None, None, None, None), (3, "", "en", "s", 0),
                        (None, long, "de", "s", 9)], schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns, name
        assert stage(spark, docs.limit(0), SF).count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 4
