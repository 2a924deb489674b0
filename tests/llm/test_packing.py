import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from pyspark.sql import functions as F

from clickloom.llm import packing, tokens

from .helpers import awkward, prose, table

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", "a", " a", "a ", "a  b", "\n", "a\n b", "a \nb", "it's we'll 's 'll don't", "x　y", "a\tb", "   x",
    "<|endoftext|> x <|endoftext|>", "hello<|endoftext|>world", " <|endoftext|>  y", "<|endoftext| >", "a" * 900 + "<|endoftext|>", "1 2 3.5 a1b2", "é ü 漢字 𝔘", "a" * 5000 + " " * 900 + "b", "\x85  x",
    "a\x1cb", "!!!??--==", " \n\n  \t", "a\r\n\r\nb", "'S 'LL", "  a",
]


FULL = tokenizers.Tokenizer.from_file(PATH)


def reference(text):
    return FULL.encode(text, add_special_tokens=False).ids


def test_ids_are_those_of_the_tokenizers_library():
    rng = random.Random(1)
    chars = "abc dé'\n\t .,1２漢  sS-_"
    texts = ODD + ["".join(rng.choice(chars) for _ in range(60)) for _ in range(300)]
    own = tokens.tokenizer(PATH)
    for text in texts:
        assert own.ids(text).tolist() == reference(text), repr(text)


@pytest.mark.parametrize("n", [1, 2, 7, 400])
def test_windows_hold_every_piece_and_never_overflow(n):
    rng = np.random.default_rng(n)
    lengths = rng.integers(1, 2048, n)
    windows = packing.pack_group(lengths, 2048)
    sums = np.bincount(windows, lengths)
    assert len(windows) == n and sums.max() <= 2048 and (sums > 0).all()


def test_differencing_evens_windows_out():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 100, 4000)
    placed, largest = packing.difference(lengths, 50)
    sums = np.bincount(placed, lengths, 50)
    assert sums.max() == largest and sums.max() - sums.min() <= 2


def test_count_rises_when_pieces_do_not_fit():
    assert len(set(packing.pack_group(np.array([1100] * 6), 2048).tolist())) == 6


def test_packed_documents_can_be_read_back(spark, tmp_path):
    rows = [(k, prose(k, 5 + 37 * k % 900), "en", "a", 0) for k in range(120)]
    docs = table(spark, str(tmp_path / "d"), rows)
    pieces = packing.tokenised_pieces(docs, PATH)
    packed = packing.pack_pieces(pieces).cache()
    by_doc, by_sequence = {}, {}
    for r in packed.collect():
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for k, text, *_ in rows:
        parts = sorted(by_doc[k], key=lambda r: r["start"])
        ids = np.frombuffer(b"".join(bytes(r["ids"]) for r in parts), "<u4")
        assert ids.tolist() == [*reference(text), 1] and parts[0]["doc_tokens"] == len(ids)
    total = 0
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
        total += at
    assert len(by_sequence) * 2048 < 1.05 * total
    whole = {r["sequence_id"]: r for r in packing.assemble(packed).collect()}
    for number, parts in by_sequence.items():
        data = b"".join(bytes(r["ids"]) for r in sorted(parts, key=lambda r: r["offset"]))
        n = len(data) // 4
        full = n if n & (n - 1) == 0 else 2048
        assert bytes(whole[number]["ids"]) == data + bytes(4 * (full - n)) and whole[number]["n_tokens"] == n


def test_awkward_rows(spark, tmp_path):
    docs = awkward(spark, str(tmp_path / "d"))
    pieces = packing.tokenised_pieces(docs, PATH).withColumn("crc", F.crc32("ids"))
    got = packing.pack_pieces(pieces).collect()
    ends = zlib.crc32(np.array([1], "<u4").tobytes())
    assert sum(r["crc"] == ends and r["doc_tokens"] == 1 for r in got) == 2  # null and empty
    assert len({r["_row"] for r in got}) == 10
    assert packing.pack_pieces(packing.tokenised_pieces(docs.limit(0), PATH)).count() == 0
