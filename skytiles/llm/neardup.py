"""Near-duplicate documents by MinHash with tensored banding.

A document's set holds the distinct ``shingle``-word shingles of its text
(words: runs without white space, A-Z lower-cased); a text of fewer words
is one shingle. Two documents are linked when ``100 * intersection >=
percent * union`` on the full sets; a group is what links connect.

Candidates come from hash tables whose keys are made by tensoring: two
collections of ``SIDE`` hashes (each of ``WIDTH`` minhashes) give ``SIDE *
SIDE`` keys, one per pair, so ``2 * SIDE * WIDTH`` minhashes serve where
independent tables would need ``2 * SIDE**2 * WIDTH``. A pair of
similarity s shares a key with probability ``(1 - (1 - s**WIDTH)**SIDE)**2``
(0.9998 at 0.8, 0.99998 at 0.85 with the defaults).

No bucket is expanded into all its pairs:

1. documents with equal sets form a class, represented by its smallest id;
2. every bucket links its members to one of them (a star), the member that
   meets most others over all buckets, as an original does among its edited
   copies; the candidate pairs are confirmed on full sets;
3. documents of buckets that still hold several components are compared
   across components, so a link that a star misses is found as well. They
   meet on prefixes: with the shingles of every set in one order, rarest
   first, two linked sets share one of their first ones (about a fifth), and
   the place of the first that they share bounds the whole intersection.
   Places that the bound rules out against the smallest set around are
   dropped, and a shingle left in one component is done. So copies with
   edits of their own, which share only what all share, are never compared
   with each other.

Before texts are shuffled, a pair must pass two filters: the exact size
bound (the smaller set has ``percent`` % of the larger one's size) and at
least ``AGREE`` equal minhashes of all (a pair at the limit fails that
with a probability of about one in a million).

Defined cases: null, empty and word-free texts have an empty set and are
linked with nothing; rows that repeat an id are one document (but for
those without words), linked to whatever one of its rows is linked to; a null id takes no part (its
component is null, and the row is kept); very long texts have all their
shingles; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sizing import broadcast_if_small
from ..session import write_scratch_table
from .common import (gram_hashes, maybe_member, mix, share_code, string_bytes, text_slices,
                     unused_name, without_keys, word_hashes, word_table)

SHINGLE = 5        # words
PERCENT = 80       # least similarity
SIDE = 9           # hashes in each of the two collections
WIDTH = 2          # minhashes in a hash
SLOTS = 1 << 18    # hash slots that count how common a shingle is
AGREE = 16         # equal minhashes of 2 * SIDE * WIDTH that a candidate needs

# --- Fixed value: words hold every byte but space and 0x09-0x0D.
WORD_BYTES = word_table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)

_N_MIN = 2 * SIDE * WIDTH
_rng = np.random.Generator(np.random.PCG64(20240229))
_MULT = _rng.integers(0, 1 << 63, _N_MIN, np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, _N_MIN, np.uint64)


def shingle_sets(arr: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every row (sorted within the row), one
    after another, and their number per row."""
    data, offsets = string_bytes(arr)
    hashes, _, _, counts = word_hashes(data, offsets, WORD_BYTES)
    grams = gram_hashes(hashes, shingle)
    sets, at = [], 0
    for n in counts.tolist():
        if n >= shingle:
            sets.append(np.unique(grams[at:at + n - shingle + 1]))
        elif n:
            sets.append(gram_hashes(hashes[at:at + n], n))
        else:
            sets.append(hashes[:0])
        at += n
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    return (np.concatenate(sets) if sets else hashes[:0]), sizes


def _signature_rows(ids: pa.Array, texts: pa.Array, shingle: int) -> pa.RecordBatch:
    values, sizes = shingle_sets(texts, shingle)
    some = np.flatnonzero(sizes)
    starts = (np.cumsum(sizes) - sizes)[some]
    keys = np.zeros((len(sizes), 2), np.uint64)
    least = np.zeros((len(sizes), _N_MIN), np.uint64)
    if len(some):
        keys[some, 0] = np.add.reduceat(mix(values), starts)
        keys[some, 1] = np.add.reduceat(mix(values ^ np.uint64(0xA5A5A5A55A5A5A5A)), starts)
        scratch = np.empty_like(values)
        for i in range(_N_MIN):
            np.multiply(values, _MULT[i], out=scratch)
            np.add(scratch, _ADD[i], out=scratch)
            least[some, i] = np.minimum.reduceat(scratch, starts)
    # WIDTH minhashes make one hash; its place in the collection is mixed in.
    hashed = np.zeros((len(sizes), 2 * SIDE), np.uint64)
    for k in range(2 * SIDE):
        h = np.full(len(sizes), k + 1, np.uint64)
        for w in range(WIDTH):
            h = mix(h ^ least[:, k * WIDTH + w])
        hashed[:, k] = h
    top = (least >> np.uint64(32)).astype(np.uint32).view(np.int32)
    listed = lambda m, t: pa.FixedSizeListArray.from_arrays(
        pa.array(np.ascontiguousarray(m).ravel().view(t)), m.shape[1]).cast(
            pa.list_(pa.from_numpy_dtype(t)))
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(sizes), pa.array([k.tobytes() for k in keys], pa.binary()),
         listed(hashed[:, :SIDE], np.int64), listed(hashed[:, SIDE:], np.int64),
         listed(top, np.int32)],
        ["id", "n", "key", "a", "b", "least"])


def signatures(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """Per row: ``id, n`` (set size), ``key`` (identity of the set), the two
    hash collections ``a, b`` and the minhashes ``least``."""
    share_code(docs.sparkSession)
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "text"):
                yield _signature_rows(part.column("id"), part.column("text"), shingle)

    kind = narrow.schema["id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"id {kind}, n bigint, key binary, a array<bigint>, "
                                  "b array<bigint>, least array<int>")


def _texts_of(ids: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Stored rows ``id, text`` that hold every document of ``ids`` (and
    hardly any other): later joins shuffle only these."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return write_scratch_table(maybe_member(rows, "id", ids, "id"), "neardup-texts")


def _confirmed(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str,
               shingle: int, percent: int) -> DataFrame:
    """Of the candidate pairs ``u, v`` those that are linked, by their full
    sets. Only texts in a pair are shuffled."""
    if pairs.isEmpty():
        return pairs
    texts = _texts_of(pairs.select(F.col("u").alias("id")).union(pairs.select("v")),
                      docs, id_col, text_col)
    both = (pairs.join(texts.select(F.col("id").alias("v"), F.col("text").alias("text_v")), "v")
            .join(texts.select(F.col("id").alias("u"), F.col("text").alias("text_u")), "u")
            .select("u", "v", "text_u", "text_v"))

    def run(batches):
        known, known_set = None, None       # rows come sorted by u: one set serves many
        for batch in batches:
            for part in text_slices(batch, "text_v"):
                values, sizes = shingle_sets(part.column("text_v"), shingle)
                ends_ = np.cumsum(sizes)
                centre = part.column("text_u")
                linked = []
                for i, (n, end) in enumerate(zip(sizes.tolist(), ends_.tolist())):
                    if centre[i].as_py() != known or known_set is None:
                        known = centre[i].as_py()
                        known_set = shingle_sets(centre.slice(i, 1), shingle)[0]
                    m = len(known_set)
                    common = len(np.intersect1d(values[end - n:end], known_set,
                                                assume_unique=True))
                    linked.append(100 * common >= percent * (n + m - common))
                yield part.select(["u", "v"]).filter(pa.array(linked, pa.bool_()))

    kind = pairs.schema["u"].dataType.simpleString()
    return write_scratch_table(both.mapInArrow(run, f"u {kind}, v {kind}"), "neardup-links")


def _slot_counts(texts: DataFrame, shingle: int) -> np.ndarray:
    """About how often each shingle occurs, by hash slot: ``SLOTS`` numbers,
    whatever the number of texts. They only order the shingles."""
    def run(batches):
        counts = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for part in text_slices(batch, "text"):
                values, _ = shingle_sets(part.column("text"), shingle)
                counts += np.bincount(_slot(values), minlength=SLOTS)
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(counts[met])], ["s", "c"])

    found = (texts.mapInArrow(run, "s bigint, c bigint").groupBy("s").agg(F.sum("c").alias("c"))
             .toArrow())
    counts = np.zeros(SLOTS, np.int64)
    counts[found.column("s").to_numpy()] = found.column("c").to_numpy()
    return counts


def _slot(values: np.ndarray) -> np.ndarray:
    return (values & np.uint64(SLOTS - 1)).astype(np.int64)


def _prefixes(texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Rows ``v, t, i, n``: the shingles ``t`` of every set (of ``n``) that
    are among its rarest, with their place ``i`` in the common order. Two
    sets of similarity ``percent`` share one."""
    shared = texts.sparkSession.sparkContext.broadcast(_slot_counts(texts, shingle))

    def run(batches):
        counts = shared.value
        for batch in batches:
            for part in text_slices(batch, "text"):
                values, sizes = shingle_sets(part.column("text"), shingle)
                row = np.repeat(np.arange(len(sizes)), sizes)
                order = np.lexsort((values, counts[_slot(values)], row))
                starts = np.cumsum(sizes) - sizes
                place = np.arange(len(values)) - starts[row]
                first = place <= sizes[row] - (percent * sizes[row] + 99) // 100
                at = order[first]                 # rows stay in their stretch
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(pa.array(row[first])),
                     pa.array(values[at].view(np.int64)), pa.array(place[first]),
                     pa.array(sizes[row[first]])], ["v", "t", "i", "n"])

    kind = texts.schema["id"].dataType.simpleString()
    return texts.mapInArrow(run, f"v {kind}, t bigint, i bigint, n bigint")


def _across(ids: DataFrame, docs: DataFrame, id_col: str, text_col: str, shingle: int,
            percent: int) -> DataFrame:
    """Candidate pairs ``u, v`` of documents in different components, among
    the rows ``id, root``."""
    texts = write_scratch_table(_texts_of(ids, docs, id_col, text_col)
                                .join(ids.select("id"), "id", "left_semi"), "neardup-open-texts")
    rest = F.col("n") - F.col("i")                # at most so much can be shared from here on
    rows = (_prefixes(texts, shingle, percent)
            .join(ids.select(F.col("id").alias("v"), "root"), "v"))
    rows = write_scratch_table(rows, "neardup-prefixes")
    around = (rows.groupBy("t").agg(F.min("n").alias("low"), F.min("root").alias("lo"),
                                    F.max("root").alias("hi"))
              .where("lo <> hi").select("t", "low"))
    rows = (rows.join(around, "t").where(
        100 * rest >= percent * (F.col("n") + F.greatest("low", rest) - rest)).drop("low"))
    rows = write_scratch_table(_open(rows, "t"), "neardup-prefixes")
    other = rows.select("t", F.col("v").alias("w"), F.col("root").alias("root_w"),
                        F.col("n").alias("n_w"), F.col("i").alias("i_w"))
    most = F.least(rest, F.col("n_w") - F.col("i_w"))
    return (rows.join(other, "t").where(
        (F.col("root") < F.col("root_w"))
        & (100 * most >= percent * (F.col("n") + F.col("n_w") - most)))
        .select(F.least("v", "w").alias("u"), F.greatest("v", "w").alias("v")).distinct())


def components(edges: DataFrame) -> DataFrame:
    """Rows ``node, root`` (the smallest node reachable) for the nodes of
    the edges ``u, v``, by alternating large-star and small-star steps.

    Every step points nodes to the smallest neighbour and is written to
    the checkpoint folder, so lineage stays short; the number of steps is
    logarithmic in the longest chain."""
    now = write_scratch_table(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"),
                                     F.least("u", "v").alias("v")).distinct(), "star-edges")
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")) \
            .select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(least, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        large = write_scratch_table(large, "star-large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).distinct())
        now = write_scratch_table(small, "star-edges")
        roles = (now.select(F.col("u").alias("x"), F.lit(1).alias("child"), F.lit(0).alias("top"))
                 .union(now.select(F.col("v"), F.lit(0), F.lit(1)))
                 .groupBy("x").agg(F.sum("child").alias("child"), F.max("top").alias("top")))
        if roles.where("child > 1 or (child = 1 and top = 1)").isEmpty():
            break                       # every node has one parent, a root
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _open(placed: DataFrame, key: str) -> DataFrame:
    """The rows of groups that hold more than one ``root``."""
    several = (placed.groupBy(key).agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
               .where("lo <> hi").select(key))
    return placed.join(several, key)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per document row: ``id, n_shingles, component, kept`` (the
    row's id is its component's smallest)."""
    signed = write_scratch_table(signatures(docs, id_col, text_col, shingle), "neardup-sets")
    live = signed.where("n > 0 and id is not null")

    # Classes of equal sets, and the representative of every row.
    classes = write_scratch_table(
        live.groupBy("key").agg(F.min("id").alias("rep"),
                                *[F.first(c).alias(c) for c in ("n", "a", "b", "least")]),
        "neardup-classes")
    rows = write_scratch_table(
        signed.select("id", "n", "key").join(classes.select("key", "rep"), "key", "left")
        .select("id", "n", F.when(F.col("id").isNotNull(), F.col("rep")).alias("rep")),
        "neardup-rows")
    # Rows that repeat an id: its classes are linked.
    repeated = write_scratch_table(
        rows.where("rep is not null").groupBy("id")
        .agg(F.min("rep").alias("m"), F.max("rep").alias("x")).where("m <> x"), "neardup-repeated")
    same_id = repeated.select(F.col("m").alias("u"), F.col("x").alias("v"))
    if not repeated.isEmpty():
        same_id = (rows.where("rep is not null").join(repeated.select("id", "m"), "id")
                   .select(F.col("rep").alias("u"), F.col("m").alias("v")))

    # Buckets with two or more members.
    keyed = classes.select("rep", F.explode(F.flatten(F.transform(
        "a", lambda x: F.transform("b", lambda y: F.xxhash64(x, y))))).alias("k"))
    buckets = write_scratch_table(
        keyed.groupBy("k").agg(F.min("rep").alias("u"), F.max("rep").alias("v"),
                               F.count(F.lit(1)).alias("n")).where("n > 1 and u <> v"),
        "neardup-buckets")
    large = buckets.where("n > 2").select("k", "n")
    members = write_scratch_table(
        maybe_member(keyed, "k", large, "k").join(large, "k")
        .select("k", F.col("rep").alias("v"), "n"), "neardup-members")
    # The member of a bucket that meets most others, of equal ones any one.
    met = members.groupBy("v").agg(F.sum("n").alias("met"))
    centre = (members.join(met, "v").groupBy("k").agg(F.max_by(
        "v", F.col("met") * (1 << 20) + F.pmod(F.xxhash64("v"), F.lit(1 << 20))).alias("u")))
    members = write_scratch_table(members.drop("n").join(centre, "k"), "neardup-members")
    facts = classes.select("rep", "n", "least")

    def side(name: str) -> DataFrame:
        return facts.select(*[F.col(c).alias(name if c == "rep" else f"{c}_{name}")
                              for c in facts.columns])

    def plausible(pairs: DataFrame) -> DataFrame:
        agree = F.aggregate(F.zip_with("least_u", "least_v", lambda x, y: (x == y).cast("int")),
                            F.lit(0), lambda s, x: s + x)
        return (pairs.join(side("v"), "v").join(side("u"), "u").where(
            (100 * F.least("n_u", "n_v") >= percent * F.greatest("n_u", "n_v"))
            & (agree >= AGREE)).select("u", "v"))

    stars = (buckets.where("n = 2").select("u", "v")
             .union(members.where("u <> v").select(F.least("u", "v"), F.greatest("u", "v")))
             .distinct())
    stars = write_scratch_table(plausible(stars), "neardup-stars")
    links = _confirmed(stars, docs, id_col, text_col, shingle, percent).union(same_id)
    roots = write_scratch_table(components(links), "neardup-roots")

    # Buckets whose members are not all in one component by now.
    placed = (members.join(roots.withColumnRenamed("node", "v"), "v", "left")
              .withColumn("root", F.coalesce("root", "v")))
    still = write_scratch_table(_open(placed, "k"), "neardup-open")
    if not still.isEmpty():
        ids = write_scratch_table(still.select(F.col("v").alias("id"), "root").distinct(),
                                  "neardup-open-ids")
        pairs = _across(ids, docs, id_col, text_col, shingle, percent)
        pairs = write_scratch_table(plausible(pairs), "neardup-across")
        more = _confirmed(pairs, docs, id_col, text_col, shingle, percent)
        if not more.isEmpty():
            roots = write_scratch_table(components(
                roots.select(F.col("node").alias("u"), F.col("root").alias("v")).union(more)),
                "neardup-roots")
    final = rows.join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    component = F.coalesce("root", "rep", "id")
    return final.select("id", F.col("n").alias("n_shingles"), component.alias("component"),
                        F.when(F.col("id").isNull(), True).otherwise(F.col("id") == component)
                        .alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The documents with one of every group left (that of the smallest id),
    columns unchanged. Every row is a document by itself here: rows that
    repeat an id are groups only where their texts are alike. Rows
    without an id all stay. Documents that stay are not shuffled."""
    row = unused_name(docs, "row")
    numbered = write_scratch_table(
        docs.withColumn(row, F.monotonically_increasing_id()), "neardup-documents")
    known = numbered.where(F.col(id_col).isNotNull())
    found = near_duplicates(known, row, text_col, shingle, percent)
    # Only groups of several rows choose; the others keep what they have.
    found = write_scratch_table(found.select("id", "component"), "neardup-groups")
    several = found.where("id <> component").select("component").distinct()
    ids = known.select(F.col(row).alias("id"), F.col(id_col).alias("doc"))
    group = found.join(broadcast_if_small(several), "component", "left_semi").join(ids, "id")
    first = group.groupBy("component").agg(F.min(F.struct("doc", "id")).alias("first"))
    gone = write_scratch_table(
        group.join(broadcast_if_small(first), "component").where(F.col("id") != F.col("first.id")).select("id"),
        "neardup-gone")
    return without_keys(numbered, {"id": F.col(row)}, gone).drop(row)
