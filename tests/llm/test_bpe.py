"""BPE by chunks against the library on whole texts."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from odd_rows import ODD_ROWS, prose
from tokenizers import Tokenizer

from ledgerlake.llm import bpe
from ledgerlake.llm.queries import op11_bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
SMALL = bpe.Settings(PATH, block_bytes=3000, least=16, mask=31, width=8, window=80)


def whole(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def by_chunks(text, setting):
    coder, data = bpe.Coder.of(PATH), np.frombuffer(text.encode(), dtype=np.uint8)
    ends = bpe.cuts(data, setting).tolist()
    chunks = [bpe._Chunk(coder, setting, *coder.encode([data[a:b].tobytes()])[0]) for a, b in zip([0, *ends], ends)]
    return bpe._join(coder, setting, chunks, {}).tolist() if chunks else [], len(chunks)


PIECES = ["<|endoftext|>", "<|endof", "text|>", "'re", "'", "ll", "   ", "\n\n", "\t ", "word", " Wort", "日本語テキスト", "é", "́", "😀", "12345", "!!!", " ", " ", "x" * 90, " " * 90, "\x00", "ab" * 70]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=120))
def test_joins_are_exact(pieces):
    text = "".join(pieces)
    assert by_chunks(text, SMALL)[0] == whole(text)


@pytest.mark.parametrize("text", ["x" * 50_000, " " * 20_000 + "a", "語" * 8_000, prose(3, 5_000), ("<|endoftext|>" * 300), ("a'" * 4000), "".join(random.Random(1).choices("ab \n'<|>é語", k=20_000))])
def test_long_texts_are_exact(text):
    for setting in (SMALL, bpe.Settings(PATH)):
        assert by_chunks(text, setting)[0] == whole(text)


def test_both_libraries_agree(spark):
    """Whole texts that the faster library may take, word starts included."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    texts = [r[0] or "" for r in rows] + ["".join(random.Random(n).choices("ab'sreltvmd \n\t,.1²½ªé“—", k=3000)) for n in range(20)]
    coder = bpe.Coder.of(PATH)
    assert coder.ranked and sum(bool(bpe._PLAIN.fullmatch(t)) for t in texts) > 20
    for text, (ids, starts) in zip(texts, coder.encode([t.encode() for t in texts])):
        starts = coder.plain_starts(ids) if starts is None else starts
        library = LIBRARY.encode(text, add_special_tokens=False)
        assert ids.tolist() == library.ids
        words = library.word_ids
        assert all(n == 0 or words[n] != words[n - 1] for n in np.flatnonzero(starts))


def test_texts_really_are_cut_and_cut_alike():
    passage = prose(1, 2_000)
    parts = [{c for c in _chunks(prose(n, 50) + passage)} for n in (2, 3)]
    assert min(map(len, parts)) > 5 and len(parts[0] & parts[1]) > 4


def _chunks(text):
    ends = bpe.cuts(np.frombuffer(text.encode(), dtype=np.uint8), bpe.Settings(PATH)).tolist()
    return [text[a:b] for a, b in zip([0, *ends], ends)]


def test_query_over_odd_rows(spark, docs_of, tmp_path):
    rows = [*ODD_ROWS, (20, "a <|endoftext|> b" * 400), (21, "日本語 " * 3000), (22, prose(9, 9000)), (23, "x" + prose(9, 9000))]
    docs_of(rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((tuple(r) for r in op11_bpe(spark, str(tmp_path)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()), key=str)
    want = sorted(((i, len(whole(t)), hashlib.sha256(np.array(whole(t), "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows), key=str)
    assert got == want


def test_small_blocks_and_many_copies(spark, docs_of):
    """A text that most rows hold is encoded by one shard, whatever number of blocks asks."""
    hot = prose(5, 600)
    rows = [(n, hot if n % 3 else prose(n, 200)) for n in range(120)]
    got = bpe.decode(bpe.encode(docs_of(rows), SMALL, shards=3), SMALL).collect()
    assert {(r["doc_id"], r["n_tokens"], bytes(r["ids"]), r["decoded"]) for r in got} == {(i, len(whole(t)), np.array(whole(t), "<u4").tobytes(), t) for i, t in rows}
    none = bpe.decode(bpe.encode(docs_of([(1, "x")]).where("false"), SMALL), SMALL)
    assert none.collect() == [] and none.columns == ["doc_id", "n_tokens", "ids", "decoded"]
