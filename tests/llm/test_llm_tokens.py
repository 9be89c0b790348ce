"""Token alignment, packing and the prefix trie, each against brute force."""

import bisect
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skytiles.llm import alignment, packing, prefixtrie, queries

SF = "/root/testdata/sf0.001"
BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")


def odd_texts():
    rnd = random.Random(3)
    plain = [" ".join("".join(rnd.choice("aeioutnsrßéü") for _ in range(rnd.randint(1, 9)))
                      + rnd.choice(["", "", ".", ",", ".\n", "'s"]) for _ in range(n))
             for n in (1, 2, 5, 30, 200)]
    return [None, "", " ", "  ", "\n", "a", "  two  blanks ", "tab\tand\r\nline\n\n\nends  ",
            "a▁b", "<|endoftext|> </s> <s> <unk> <0x41>", "中文字 текст Σίσυφος ΟΔΟΣ 🙂🙂",
            "it's we'll I'D 've ''s ,'s x'ren", "İstanbul ŉ ſ ß ª ½ ²", "é ́x y z",
            "\x00\x01\x02 \x1c \x85 mark\x01 in", "a<|startoftext|>b <|ENDOFTEXT|>", "x" * 3000,
            " " * 5000, "same text", "same text", *plain, " ".join(plain * 10)]


# --------------------------------------------------------------- alignment

def byte_tokens(tokenizer, text):
    letter = alignment.byte_letters()
    e = tokenizer.encode(" " + text, add_special_tokens=False)
    return [(i, bytes(letter[c] for c in tokenizer.id_to_token(i))) for i in e.ids]


def piece_tokens(sp, text):
    return [(i, bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i)
             else sp.id_to_piece(i).replace("▁", " ").encode()) for i in sp.encode(text)]


def brute_alignment(docs):
    one = Tokenizer.from_file(BYTE)
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    found, counts = [], Counter()
    for doc, text in docs:
        a, b = (byte_tokens(one, text), piece_tokens(two, text)) if text else ([], [])
        whole = (" " + (text or "")).encode()
        if b"".join(t for _, t in a) != whole or b"".join(t for _, t in b) != whole:
            a = b = []
        spans = []
        for side in (a, b):
            at, own = 0, []
            for i, t in side:
                own.append((i, at, at + len(t)))
                at += len(t)
            spans.append(own)
        common = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
        groups = [([], []) for _ in common]
        for side, own in enumerate(spans):
            for i, _, e in own:
                groups[bisect.bisect_left(common, e)][side].append(str(i))
        groups = ["|".join(map(",".join, g)) for g in groups]
        pairs, j = [], 0
        for x, s, e in spans[0]:
            while j and spans[1][j][1] >= s:
                j -= 1
            k = j
            while k < len(spans[1]) and spans[1][k][1] < e:
                if spans[1][k][2] > s:
                    pairs.append((x, spans[1][k][0]))
                    j = k
                k += 1
        counts.update(pairs)
        found.append((doc, len(a), len(b), len(groups), pairs, ";".join(groups)))
    best = defaultdict(int)
    for (_, y), c in counts.items():
        best[y] = max(best[y], c)
    return sorted(((doc if doc is not None else -1), n, m, g, len(p),
                   sum(counts[q] == best[q[1]] for q in p), sum(counts[q] for q in p), text)
                  for doc, n, m, g, p, text in found)


def aligned(spark, docs, **kw):
    df = spark.createDataFrame([(d, t, 1, "r") for d, t in docs],
                               "doc_id long, text string, row int, pairs string")
    stored = alignment.store_alignment(alignment.align_documents(df, BYTE, PIECE))
    out = alignment.score_documents(stored, alignment.pair_counts(stored), **kw).select(
        F.coalesce("doc_id", F.lit(-1)), "n_a", "n_b", "n_groups", "n_links", "n_best",
        "count_sum", "groups")
    return sorted(map(tuple, out.collect()))


def test_alignment_against_brute_force(spark):
    docs = [(k if k != 7 else None, t) for k, t in enumerate(odd_texts())] + [(3, "same text")]
    want = brute_alignment(docs)
    assert aligned(spark, docs) == want
    assert aligned(spark, docs, max_broadcast=0) == want        # counts joined by shuffle
    assert sum(w[3] for w in want) > 1000 and any(w[3] < w[2] for w in want)


def test_alignment_of_an_empty_table(spark):
    assert aligned(spark, []) == []


def test_diagonal_walk_against_common_ends():
    rng = np.random.default_rng(5)
    for share in (0.05, 0.5, 0.95):
        for n in (1, 2, 40, 3000):
            ends = np.cumsum(rng.integers(1, 4, n))
            a = ends[np.append(rng.random(n - 1) < share, True)]
            b = ends[np.append(rng.random(n - 1) < 0.7, True)]
            common = np.intersect1d(a, b)
            i, j = np.searchsorted(a, common) + 1, np.searchsorted(b, common) + 1
            stretch = np.stack([np.append(0, i[:-1]), i, np.append(0, j[:-1]), j], axis=1)
            odd = (stretch[:, 1] - stretch[:, 0] > 1) | (stretch[:, 3] - stretch[:, 2] > 1)
            for lane in (1, 3, 512):
                got = alignment.irregular_groups(a, b, lane)
                # An unequal group starts where its first ends differ.
                assert got.tolist() == stretch[odd].tolist()


def test_alignment_query(spark):
    docs = [(r["doc_id"], r["text"]) for r in
            spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = [(*w[:7], hashlib.sha256(w[7].encode()).hexdigest() if w[7] else "")
            for w in brute_alignment(docs)]
    assert sorted(map(tuple, queries.op11_alignment(spark, SF).collect())) == want


# ----------------------------------------------------------------- packing

def test_word_tokens_equal_the_tokenizer():
    tokens, library = packing.WordTokens(WORD), Tokenizer.from_file(WORD)
    texts = [t or "" for t in odd_texts()]
    for text, ids in zip(texts, tokens.encode(texts)):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text[:50]
    letter, vocab = packing.byte_letters(), []
    for token in library.get_vocab():
        try:
            vocab.append(bytes(letter[c] for c in token.removesuffix("</w>")).decode())
        except (KeyError, UnicodeDecodeError):
            pass
    vocab = [w for w in vocab if "\n" not in w]
    assert len(vocab) > 40000
    want = [e.ids for e in library.encode_batch(vocab, add_special_tokens=False)]
    assert [x.tolist() for x in tokens.encode(vocab)] == want


def test_best_fit_against_a_plain_search():
    rng = np.random.default_rng(8)
    for length in (1, 2, 7, 64, 100):
        sizes = rng.integers(1, length + 1, 300)
        sequence, offset = packing.best_fit(sizes, length)
        room: list[int] = []
        for size in sorted(sizes.tolist(), reverse=True):
            fits = [r for r in room if r >= size]
            if fits:
                room[room.index(min(fits))] -= size
            else:
                room.append(length - size)
        left = length - np.bincount(sequence, weights=sizes)
        assert sorted(left.tolist()) == sorted(room)
        check_places(list(zip(sequence, offset, sizes)), length)


def check_places(rows, length):
    at = defaultdict(list)
    for sequence, offset, size in rows:
        at[sequence].append((offset, size))
    for own in at.values():
        end = 0
        for offset, size in sorted(own):
            assert offset == end            # gapless from 0
            end += size
        assert end <= length
    return len(at)


def test_packing(spark):
    library = Tokenizer.from_file(WORD)
    docs = [(k if k != 5 else None, t) for k, t in enumerate(odd_texts())] * 3
    df = spark.createDataFrame([(d, t, 0, 0) for d, t in docs],
                               "doc_id long, text string, piece int, row int")
    rows = packing.pack_documents(df, WORD, length=64, shard=20).collect()
    want = Counter()
    for doc, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        for p in range(0, len(ids), 64):
            own = np.array(ids[p:p + 64], "<u4").tobytes()
            want[doc, p // 64, p, len(own) // 4, own] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], bytes(r["ids"]))
                   for r in rows) == want
    assert all(r["crc"] == zlib.crc32(bytes(r["ids"])) for r in rows)
    check_places([(r["sequence_id"], r["offset"], r["length"]) for r in rows], 64)
    packed = packing.sequences(spark.createDataFrame(rows)).collect()
    assert sum(r["n_pieces"] for r in packed) == len(rows)
    by_place = {(r["sequence_id"], r["offset"]): bytes(r["ids"]) for r in rows}
    for r in packed:
        own = bytes(r["ids"])
        assert own == b"".join(by_place[k] for k in sorted(by_place)
                               if k[0] == r["sequence_id"]) and len(own) <= 256


def test_sharded_packing_is_nearly_as_tight(spark):
    rng = np.random.default_rng(2)
    sizes = np.minimum(rng.geometric(0.02, 4000), 256)
    pieces = spark.createDataFrame([(k, int(s)) for k, s in enumerate(sizes)],
                                   "row long, length long")
    from skytiles.session import write_scratch_table
    placed = packing.place_pieces(write_scratch_table(pieces, "test-pieces"), 256, shard=500)
    rows = placed.join(pieces, "row").collect()
    assert len(rows) == len(sizes)
    used = check_places([(r["sequence_id"], r["offset"], r["length"]) for r in rows], 256)
    alone = len(set(packing.best_fit(sizes, 256)[0].tolist()))
    assert used <= alone + 3 and alone >= -(-int(sizes.sum()) // 256)


def test_packing_of_an_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack_documents(df, WORD).count() == 0


def test_packing_query(spark):
    rows = queries.op12_packing(spark, SF).collect()
    used = check_places([(r["sequence_id"], r["offset"], r["length"]) for r in rows], 4096)
    total = sum(r["length"] for r in rows)
    assert used <= -(-total // 4096) + 1
    assert len({r["doc_id"] for r in rows}) == spark.read.parquet(
        f"{SF}/documents.parquet").count()


# -------------------------------------------------------------- prefix trie

def brute_trie(table):
    own = defaultdict(list)
    for conv, turn, role, text in table:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    node = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            node[tuple(turns[:d])].append(c)
    children, leaves, saved = Counter(), Counter(), Counter()
    for path in node:
        if path:
            children[path[:-1]] += 1
    for path, own_ in node.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(own_) - 1) * (len(path[-1][1]) if path else 0)
    return sorted((min(m), len(p), min(node[p[:-1]]) if p else -1, len(m), children[p], leaves[p],
                   saved[p], hashlib.sha256(",".join(map(str, sorted(
                       c for c in m if len(built[c]) == len(p)))).encode()).hexdigest())
                  for p, m in node.items())


def trie(spark, table, **kw):
    df = spark.createDataFrame(table, "conv_id long, turn long, role string, text string")
    df = df.withColumn("conv", F.lit("x")).withColumn("k", F.lit(0)).withColumn("d", F.lit(1))
    out = prefixtrie.prefix_trie(*prefixtrie.shared_heads(prefixtrie.ordered_turns(df)), **kw)
    return sorted(map(tuple, out.select(
        "conv_id", "depth", F.coalesce("parent_conv_id", F.lit(-1)), "n_convs", "n_children",
        "n_leaves", "saved_tokens", "ends_sha256").collect()))


def conversations(seed, n=60, longest=9):
    rnd = random.Random(seed)
    table = [(None, 1, "user", "no id")]
    for c in range(0, n * 7, 7):
        for turn in range(rnd.randint(1, longest)):
            table.append((c, turn, rnd.choice(["user", None]),
                          rnd.choice(["hi", "", None, "é🙂", "x" * 40])))
    table += [(0, None, "user", "null turn"), (0, None, None, None), (14, 0, "user", "hi"),
              (14, 0, "user", "hi"), (100, 0, "user", "hi"), (1001, 0, "a", "only"),
              (1002, 0, "a", "only")]
    rnd.shuffle(table)
    return table


@pytest.mark.parametrize("shard, room", [(prefixtrie.SHARD, prefixtrie.ROOM), (20, 4), (3, 1)])
def test_trie_against_brute_force(spark, shard, room):
    table = conversations(4)
    table += [(5000, k, "u", "long") for k in range(40)]          # bands of one conversation
    assert trie(spark, table, shard=shard, room=room) == brute_trie(table)


def test_trie_of_copies_and_a_common_first_turn(spark):
    table = [(c, k, "u", f"same {k}") for c in range(80) for k in range(7)]
    table += [(200 + c, 0, "u", "same 0") for c in range(40)]
    assert trie(spark, table, shard=10, room=5) == brute_trie(table)


def test_trie_of_an_empty_table(spark):
    assert trie(spark, []) == []


def test_queue_spills_and_keeps_order():
    rnd = random.Random(1)
    messages = [(rnd.randint(-5, 0), rnd.randint(0, 9), 0, 1, rnd.randint(0, 5), rnd.randint(0, 9))
                for _ in range(500)]
    queue = prefixtrie.SpillingQueue(room=8)
    for m in messages:
        queue.push(m)
    assert len(queue.files) > 10 and len(queue.heap) <= 8
    for key in sorted({m[:3] for m in messages}):
        own = [m[3:] for m in messages if m[:3] == key]
        assert queue.take(key) == tuple(map(sum, zip(*own)))
    assert queue.take((1, 1, 1)) == (0, 0, 0)
