"""Added tokens written in texts: ids of the library as its file sets it up."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import AddedToken, Tokenizer

from revlens.llm import best_fit, chunks, textscan, token_blocks
from tests.llm import cases

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
END, START = "<|endoftext|>", "<|startoftext|>"
PARTS = ["", " ", "a", "A b ", " é\n", "x,", "  ", "\u3000", "<|", "|>", "<|endof", "text|>", END, START, END.upper(), f"{END}{END}", "<s>", "e", "\u0301"]
TEXTS = [a + b + c for a in PARTS for b in (END, START, "<|endof", " ") for c in PARTS]


def untouched(path):
    t = Tokenizer.from_file(path)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def same(rows, encode, texts, limit=300):
    for text in textscan.slices(pa.array(texts), limit):
        ids, n = rows(text)
        assert n.sum() == len(ids)
        at = 0
        for i in range(text.rows):
            assert ids[at : at + n[i]].tolist() == encode(texts[text.first + i]), repr(texts[text.first + i])
            at += n[i]


@pytest.mark.parametrize("path,kind,lower", [(BYTE, chunks.spaced_words, False), (WORD, chunks.bare_words, True)])
def test_added_tokens_have_the_library_ids(path, kind, lower):
    same(chunks.JsonTokenizer(path, kind, lower, True).rows, untouched(path), TEXTS)


def test_added_tokens_that_strip_or_normalise(tmp_path):
    path = str(tmp_path / "t.json")
    t = Tokenizer.from_file(WORD)
    t.add_tokens([AddedToken("Foo bar", normalized=True), AddedToken("<x>", lstrip=True, rstrip=True, normalized=False)])
    t.save(path)
    texts = ["a foo  BAR b", "a  <x>  b", "", f"x{END} foo bar"]
    same(chunks.JsonTokenizer(path, chunks.bare_words, True, True).rows, untouched(path), texts)


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_queries_keep_added_tokens(spark):
    rows = list(enumerate([f"a {END} b", "plain text", None, f"{START}A,{END}", END, f"x {END.upper()} y"]))
    docs = cases.documents(spark, rows)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_blocks.read_blocks(spark, token_blocks.write_blocks(docs, BYTE, 2)).collect()}
    packed = {r.doc_id: (r.length, r.ids_crc32) for r in best_fit.pack(docs, WORD, 0).collect()}
    at = 0
    for i, text in rows:
        ids = [*untouched(BYTE)(text), 2]
        assert got[i] == (at, len(ids), crc(ids))
        at += len(ids)
        ids = [*untouched(WORD)(text), 0]
        assert packed[i] == (len(ids), crc(ids))
