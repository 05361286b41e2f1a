"""Token counts, ORC files and packing against the libraries run on whole texts."""

import collections
import glob
import zlib

import numpy as np
import public_tokenizers
import pyarrow.orc
import pytest
import sentencepiece
from tokenizers import Tokenizer

import messy
from __spark_entry__ import queries
from ratingloom.llm import encoding, piece_counts, sum_of_squares, token_orc
from ratingloom.session import scratch_folder

FOLDER = "/root/testdata/sf0.001"
WORDS, BYTES = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "\n", "a", " a", "  a  b ", "a\tb\r\n c", "a  b", "a  　 b", "a\x85\n b", "it's they'll x's",
       "▁", "a▁ b", "a ▁b▁▁ c", "x\n\n▁y \n", "ﬁ ①Ⅷ é ́x", "ΟΔΟΣ ΣΑΣ.", "<|endoftext|>", "a<|endoftext|>b <|endoftext|> c",
       "<s></s><unk>", "0" * 500, "word" * 3000, "!\x1c\x1d !", "🙂🙂 a\U0001F468‍\U0001F469", "\x00 a\x00b"]


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] or "" for r in rows}


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_stretches_encode_like_whole_texts(path, texts):
    library, encoder = Tokenizer.from_file(path), encoding.Encoder(path)
    for text in [*ODD, *(t for _, t, _ in messy.ROWS if t), *texts.values()]:
        want = np.array(library.encode(text, add_special_tokens=False).ids, "<u4")
        assert encoder.encode(text) == want.tobytes(), text[:80]


def test_pieces_of_pre_tokens_add_up(texts):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert not piece_counts.crossing(PIECES)
    for text in [*ODD, *(t for _, t, _ in messy.ROWS if t), *texts.values()]:
        units = piece_counts.pre_tokens(text)
        assert "".join(units) == (f" {text}" if text else "")
        total = sum(1 if len(u) == 1 and u != "\n" else
                    len(library.encode(u if u[0] == "\n" else u[1:])) - (u[0] == "\n") for u in units)
        assert total == len(library.encode(text)), repr(text[:80])


@pytest.mark.parametrize("frequent", [0, 20, 1 << 18])
def test_counts_on_messy_rows(spark, frequent):
    """With none, a few and all pre-tokens sent to the tasks."""
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    found = piece_counts.token_counts(messy.documents(spark), PIECES, limit=100, frequent=frequent).collect()
    want = collections.Counter()
    for doc_id, text, _ in messy.ROWS:
        n = len(library.encode(text or ""))
        want[doc_id, len((text or "").encode()), n, n > 100] += 1
    assert collections.Counter(map(tuple, found)) == want
    assert piece_counts.token_counts(messy.nothing(spark), PIECES).count() == 0


def test_counts_query(spark, texts):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    found = queries()["op8_piece_counts"](spark, FOLDER).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in found} == {i: len(library.encode(t)) for i, t in texts.items()}


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_orc_query(spark, texts):
    library, start, want = Tokenizer.from_file(WORDS), 0, {}
    for i in sorted(texts):
        ids = library.encode(texts[i], add_special_tokens=False).ids + [1]
        want[i] = (start, len(ids), crc(ids))
        start += len(ids)
    found = queries()["op2_token_orc"](spark, FOLDER).collect()
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in found} == want


def test_orc_files_on_messy_rows(spark):
    path = scratch_folder(spark, "orc-test")
    token_orc.write_tokens(messy.documents(spark), path, WORDS, end=1, files=4)
    found = sorted(token_orc.summaries(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in found] == sorted((r[0] for r in messy.ROWS), key=lambda i: (i is not None, i))
    assert [r["start"] for r in found] == list(np.cumsum([0] + [r["n_tokens"] for r in found[:-1]]))
    library = Tokenizer.from_file(WORDS)
    want = collections.Counter((i, crc(library.encode(t or "", add_special_tokens=False).ids + [1]))
                               for i, t, _ in messy.ROWS)
    assert collections.Counter((r["doc_id"], r["ids_crc32"]) for r in found) == want
    some = token_orc.find_tokens(spark, path, [9, 12])
    assert sorted(r["doc_id"] for r in some.collect()) == [9, 12]
    assert "PushedFilters: [In(doc_id, [12,9])]" in some._jdf.queryExecution().toString() or \
        "PushedFilters: [In(doc_id, [9,12])]" in some._jdf.queryExecution().toString()
    files = glob.glob(path.removeprefix("file:") + "/*.orc")
    assert len(files) > 1 and all(pyarrow.orc.ORCFile(f).compression == "ZSTD" for f in files)
    assert any(b"\x07" in open(f, "rb").read() for f in files)


def test_orc_of_no_rows(spark):
    path = scratch_folder(spark, "orc-empty")
    token_orc.write_tokens(messy.nothing(spark), path, WORDS, end=1)
    assert token_orc.summaries(spark, path).count() == 0


def check_packing(rows, encoded, length):
    """encoded: lists of ids, in any order; rows with equal ids are told apart by their pieces."""
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append(r)
        assert 0 < r["length"] <= length and (r["piece"] == 0 or r["length"] == length)
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= length
    want = collections.Counter()
    for doc_id, ids in encoded:
        sizes, start = sum_of_squares.piece_sizes(len(ids), length), 0
        assert len(sizes) == -(-len(ids) // length)
        for piece, size in enumerate(sizes):
            want[doc_id, piece, start, size, crc(ids[start:start + size])] += 1
            start += size
    assert collections.Counter(
        (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    return len(sequences)


def test_packing_query(spark, texts):
    library = Tokenizer.from_file(BYTES)
    encoded = [(i, library.encode(t, add_special_tokens=False).ids + [2]) for i, t in texts.items()]
    n = check_packing(queries()["op7_sum_of_squares"](spark, FOLDER).collect(), encoded, 1024)
    assert n <= 1.02 * sum(len(ids) for _, ids in encoded) / 1024 + 2


def test_packing_of_messy_rows(spark):
    library = Tokenizer.from_file(BYTES)
    encoded = [(i, library.encode(t or "", add_special_tokens=False).ids + [2]) for i, t, _ in messy.ROWS]
    made = sum_of_squares.encoded(messy.documents(spark), BYTES, end=2, length=64)
    for group in (4, 1000):
        check_packing(sum_of_squares.pack(made, length=64, group=group).collect(), encoded, 64)
    assert sum_of_squares.pack(sum_of_squares.encoded(messy.nothing(spark), BYTES, 2)).count() == 0


def test_place_takes_the_smallest_sum_of_squares():
    rng = np.random.default_rng(3)
    sizes = np.sort(rng.integers(1, 21, 400))[::-1].copy()
    number, offset = sum_of_squares.place(sizes, 20)
    held = collections.Counter()

    def squares(levels):
        return sum(c * c for h, c in collections.Counter(levels.values()).items() if 0 < h < 20)

    for s, n, o in zip(sizes.tolist(), number.tolist(), offset.tolist()):
        assert held[n] == o
        options = [squares(held | {b: h + s}) for b, h in held.items() if 0 < h <= 20 - s]
        if options:
            assert squares(held | {n: o + s}) == min(options)
        else:
            assert o == 0
        held[n] += s


def test_sequences_hold_their_pieces(spark):
    docs = spark.createDataFrame([(1, [5, 6, 7]), (2, [8]), (3, [9, 9, 9, 9, 1])], "doc_id long, ids array<int>")
    packed = spark.createDataFrame([(1, 0, 3, 7, 0), (2, 0, 1, 7, 3), (3, 0, 1, 8, 0), (3, 1, 4, 9, 0)],
                                   "doc_id long, start long, length long, sequence_id long, offset long")
    found = {r["sequence_id"]: r["ids"] for r in sum_of_squares.sequences(docs, packed).collect()}
    assert found == {7: [5, 6, 7, 8], 8: [9], 9: [9, 9, 9, 1]}


def test_copies_without_an_id_are_dealt_over_groups(spark):
    rows = spark.range(4000).selectExpr("CAST(null AS bigint) AS doc_id", "5L AS n_tokens", "array(7L) AS crcs")
    found = {}
    for parts in (2, 7):
        packed = sum_of_squares.pack(rows.repartition(parts), group=100).collect()
        found[parts] = collections.Counter(r["sequence_id"] >> 32 for r in packed)
    assert sum(found[2].values()) == 4000 and max(found[2].values()) <= 200 and found[2] == found[7]
