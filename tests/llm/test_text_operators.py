"""Token blocks, piece codec, packing, substring dedup, Jaccard join, quality rules: against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from revlens.llm import best_fit, chunks, jaccard_join, piece_codec, quality_rules, range_coder, sketch, substring_dedup, textscan, token_blocks
from revlens.sources.stage import materialize
from tests.llm import cases

BYTE, WORD, PIECE = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))


def library(path):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


# --- scanning -----------------------------------------------------------------


@pytest.mark.parametrize("limit", [1, 7, 1 << 20])
def test_words_of_every_slice(limit):
    rows = [*cases.texts(), None]
    got = []
    for text in textscan.slices(pa.array(rows), limit):
        w = textscan.words(text)
        for i in range(text.rows):
            got.append([text.data[a:b].tobytes() for a, b in zip(w.start[w.first[i] : w.first[i + 1]], w.end[w.first[i] : w.first[i + 1]])])
    assert got == [cases.words(t) for t in rows]


def test_window_hash_depends_on_content_alone():
    text = next(textscan.slices(pa.array(["q a b c z", "a b c", "b a c"])))
    w = textscan.words(text)
    h = textscan.window_hash(textscan.span_hash(text.data, w.start, w.end), 3)
    assert h[1] == h[5] and len({*h[textscan.inside(w.first, 3)].tolist()}) == 4


def test_sketch_never_underestimates(spark):
    keys = np.arange(5000, dtype=np.int64) % 3001
    df = spark.createDataFrame([(int(k),) for k in keys], "k long").repartition(5)
    read = lambda batch: iter([textscan.mix(batch.column("k").to_numpy().view(np.uint64))])
    kind, levels = sketch.Twice(12), sketch.Levels(9)
    names = textscan.mix(np.arange(3001, dtype=np.uint64))
    again = kind.repeated(sketch.build(df, read, kind), names)
    assert again[:1999].all() and not again[1999:].all()
    assert (levels.level(sketch.build(df, read, levels), names) >= 1).all()


# --- 4 -------------------------------------------------------------------------


@pytest.mark.parametrize("n", [0, 1, 2, 255, 257, 513, 9000])
@pytest.mark.parametrize("vocab", [1, 2, 50257])
def test_range_coder_round_trip(n, vocab):
    rng = np.random.default_rng(n + vocab)
    for ids in (rng.integers(0, vocab, n), np.full(n, vocab - 1), np.minimum(rng.zipf(1.3, n), vocab) - 1):
        assert (range_coder.decode(range_coder.encode(ids.astype(np.int64), vocab)) == ids).all()


def test_range_coder_finds_ids_by_place_and_keeps_its_format():
    model = range_coder._Model(300, 4)
    model.counts[:] = np.arange(300) ** 2
    model._order0()
    spots = np.concatenate([np.arange(0, model.cum0[-1], 97), model.cum0[:-1], model.cum0[1:] - 1])
    assert (model.find0(spots) == np.searchsorted(model.cum0, spots, side="right") - 1).all()
    assert model.find0(np.array([(1 << 20) - 1]))[0] == 299
    # the code words of blocks that are already written
    ids = (np.arange(20000, dtype=np.int64) ** 2) % 251
    assert zlib.crc32(range_coder.encode(ids, 300)) == 2007901337


def test_spaced_words_cuts_at_every_kind_of_space():
    # (a zero-width space, which is none, is told apart by no byte that is looked at: no cut is the safe side)
    wide = "\x85\xa0\u1680\u2003\u200a\u200b\u2028\u202f\u205f\u3000"
    rng = random.Random(5)
    for _ in range(200):
        rows = ["".join(rng.choice("aB .<\t\n\x1c\u00e9\u6f22" + wide) for _ in range(rng.randrange(12))) for _ in range(3)]
        for text in textscan.slices(pa.array(rows)):
            start, _end, _first = chunks.spaced_words(text)
            expected, at = set(), 0
            for row in rows:
                for i, char in enumerate(row):
                    before = row[i - 1] if i else ""
                    spaced = char in " \t\n" and before and before not in " \t\n\x1c" + wide
                    if i == 0 or spaced or (before in ("a", "B") and char in ".<"):
                        expected.add(at)
                    at += len(char.encode())
            assert set(start.tolist()) == expected


def test_range_coder_uses_order_two_and_finds_damage():
    ids = np.tile(np.random.default_rng(1).integers(0, 50000, 500), 60)
    block = range_coder.encode(ids, 50257)
    assert len(block) < len(ids)  # under 8 bits an id, where order 0 alone needs 9
    for at in (3, 20, len(block) // 2, len(block) - 1):
        bad = bytearray(block)
        bad[at] ^= 4
        with pytest.raises(ValueError):
            range_coder.decode(bytes(bad))
    with pytest.raises(ValueError):
        range_coder.decode(block[:-4])


@pytest.mark.parametrize("block_ids", [50, 1 << 20])
def test_token_blocks(spark, block_ids):
    path = token_blocks.write_blocks(cases.documents(spark), BYTE, 2, block_ids=block_ids)
    got = token_blocks.read_blocks(spark, path, with_ids=True).collect()
    encode, at, expected = library(BYTE), 0, []
    for i, text in sorted(cases.plain(spark), key=lambda r: (r[0] is not None, r[0])):
        ids = [*encode(text), 2]
        expected.append((i, at, len(ids), crc(ids), ids))
        at += len(ids)
    assert sorted([tuple(r) for r in got], key=lambda r: r[1]) == expected


def test_token_blocks_of_an_empty_table(spark):
    path = token_blocks.write_blocks(cases.documents(spark, []), BYTE, 2)
    assert token_blocks.read_blocks(spark, path).collect() == []


def words_of(rng, n):
    return ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8)) for _ in range(n)]


def test_chunk_table_keeps_the_frequent_chunks_when_full():
    asked = []

    def encode(found):
        asked.extend(found)
        return [list(x) for x in found]

    table, rng = chunks.ChunkTable(encode, bits=10), random.Random(4)
    often = words_of(rng, 100)
    for _ in range(40):
        line = [*often, *words_of(rng, 100)]
        text = next(textscan.slices(pa.array([" ".join(line)])))
        w = textscan.words(text)
        ids, n = table.ids(text.data, w.start, w.end, textscan.span_hash(text.data, w.start, w.end))
        assert ids.tolist() == list("".join(line).encode()) and set(n.tolist()) == {8}
        assert table.held <= 512 and table.bits == 10
    # emptied when full, the table asked again for every frequent chunk
    assert sum(x.decode() in set(often) for x in asked) == 100 and len(asked) == 4100


def test_chunk_table_with_more_frequent_chunks_than_it_may_keep():
    table, rng = chunks.ChunkTable(lambda found: [list(x) for x in found], bits=6), random.Random(5)
    often = words_of(rng, 30)
    for size in (5, 20, 32, 3, 90, 1):
        for _ in range(3):
            line = [*often, *words_of(rng, size)]
            text = next(textscan.slices(pa.array([" ".join(line)])))
            w = textscan.words(text)
            ids, _n = table.ids(text.data, w.start, w.end, textscan.span_hash(text.data, w.start, w.end))
            assert ids.tolist() == list("".join(line).encode())


def test_chunks_that_are_one_piece_go_to_the_model_at_once():
    rng, coder = random.Random(6), chunks.JsonTokenizer(BYTE, chunks.spaced_words, False, True)
    letters = [chr(c) for c in (*range(65, 91), *range(97, 123), *range(0xC0, 0x180))]
    found = [rng.choice(["", " "]) + "".join(rng.choice(letters) for _ in range(rng.randrange(1, 12))) for _ in range(3000)]
    found += ["\u00d7", " \u00f7a", "a\nb", "\nab", " ", "  a", "a.", "'s", "a1", "\u00b5", "\u4e00", "<|endoftext|>", " \u0130\u0149\u017f"]
    many = []
    plain_library, coder._library = coder._library, lambda x: (many.extend(x), plain_library(x))[1]
    encode = library(BYTE)
    assert coder._encode([x.encode() for x in found]) == [encode(x) for x in found]
    assert {x.decode() for x in many} <= {x for x in found if not x.strip(" ").isalpha() or x in ("  a", "\u00b5", "\u4e00")}
    assert coder._encode([]) == [] and coder._encode([b"\n"]) == [encode("\n")]
    # another way of splitting or changing text leaves all to the library
    assert chunks.JsonTokenizer(WORD, chunks.bare_words, True).pieces is None


def test_range_coder_keeps_the_words_of_wide_blocks():
    rng, ids = np.random.default_rng(7), []
    for n in (1500, 70001):
        ids.append(np.concatenate([np.minimum(rng.zipf(1.2, n), 50000) - 1, np.tile(rng.integers(0, 50257, 300), 40)]))
    blocks = [range_coder.encode(x.astype(kind), 50257) for x in ids for kind in (np.int64, np.uint32)]
    assert [zlib.crc32(b) for b in blocks] == [149063016, 149063016, 3803761627, 3803761627]  # as coded before
    assert all((range_coder.decode(b) == x).all() for b, x in zip(blocks[::2], ids))


# --- 10 ------------------------------------------------------------------------


def test_piece_codec(spark):
    got = piece_codec.encode_decode(cases.documents(spark), PIECE, with_ids=True).collect()
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    expected = []
    for i, text in cases.plain(spark):
        ids = sp.encode(text or "", add_bos=True, add_eos=True)
        said = sp.decode(ids)
        expected.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(said.encode()).hexdigest(), ids, said))
    assert cases.ordered(tuple(r) for r in got) == cases.ordered(expected)


ODD = ["", " ", "  x", "x  ", "\n a", "▁a", "a▁b", " ▁ ", "a\u3000 b", "don't 's", "a,b.c!! 12ab", "é à\u0301 \u0338x", "\u00a0 \n b", "<s> <|endoftext|>", "漢字 ＡＢ ﬁ", "\x85 \x1c\t y", "Σ İ ΑΣ"]


@pytest.mark.parametrize("kind", ["byte", "word", "piece"])
def test_chunks_give_the_library_ids(kind):
    if kind == "piece":
        sp = sentencepiece.SentencePieceProcessor(model_file=PIECE)
        rows, encode = piece_codec.PieceCodec(PIECE).rows, sp.encode
    else:
        path = BYTE if kind == "byte" else WORD
        encode = library(path)
        rows = chunks.JsonTokenizer(path, chunks.spaced_words if kind == "byte" else chunks.bare_words, kind == "word").rows
    every = ODD + [a + b for a in ODD for b in ODD]
    for text in textscan.slices(pa.array(every), 300):
        ids, n = rows(text)
        at = 0
        for i in range(text.rows):
            assert ids[at : at + n[i]].tolist() == encode(every[text.first + i]), repr(every[text.first + i])
            at += n[i]


def test_chunk_table_is_bounded_and_right_when_it_overflows():
    table = chunks.ChunkTable(lambda found: [[len(x), x[0]] for x in found], bits=4)
    for at in range(0, 400, 40):
        many = [f"w{k}".encode() for k in range(at, at + 40)]
        data = np.frombuffer(b"".join(many), dtype=np.uint8)
        n = np.array([len(x) for x in many])
        end = np.cumsum(n)
        ids, length = table.ids(data, end - n, end, textscan.span_hash(data, end - n, end))
        assert ids.tolist() == [y for x in many for y in (len(x), x[0])] and set(length.tolist()) == {2}
        assert table.held <= len(table.begin)


# --- 6 -------------------------------------------------------------------------


@pytest.mark.parametrize("capacity", [7, 64, 2048])
def test_best_fit(spark, capacity):
    got = best_fit.pack(cases.documents(spark), WORD, 0, capacity, with_ids=True).collect()
    encode, expected = library(WORD), []
    for i, text in cases.plain(spark):
        ids = [*encode(text), 0]
        for k in range(0, len(ids), capacity):
            expected.append((i, k // capacity, k, len(ids[k : k + capacity]), crc(ids[k : k + capacity]), ids[k : k + capacity]))
    assert cases.ordered((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, r.ids) for r in got) == cases.ordered(expected)
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r.length for r in got)
    assert len(sequences) <= -(-total // capacity) * 11 / 9 + 1


def test_supersteps_fill_the_successor_gap():
    lines = best_fit.supersteps({6: 2, 4: 1, 3: 2, 1: 1}, 10)
    placed = {(length, rank): (first, offset) for length, rank, first, offset in lines}
    assert placed[(4, 0)][1] == 6  # the gap of 4 that a 6 left, filled whole
    assert len({s for _, _, first, _ in lines for s in [first]}) <= 3


def test_best_fit_of_an_empty_table(spark):
    assert best_fit.pack(cases.documents(spark, []), WORD).collect() == []


# --- 5 -------------------------------------------------------------------------


@pytest.mark.parametrize("size,gram,bits", [(35, 15, 16), (35, 15, 9), (8, 3, 16)])
def test_substring_dedup(spark, size, gram, bits):
    got = substring_dedup.remove_repeats(cases.documents(spark), size=size, gram=gram, bits=bits, keep=["uid", "n"], with_text=True).collect()
    expected = [(i, n, gone, hashlib.sha256(left).hexdigest(), left.decode(), "?", "?") for i, n, gone, left in cases.repeats(cases.plain(spark), size)]
    assert cases.ordered(tuple(r) for r in got) == cases.ordered(expected)


def test_substring_dedup_of_an_empty_table(spark):
    assert substring_dedup.remove_repeats(cases.documents(spark, []), bits=10).collect() == []


# --- 3 -------------------------------------------------------------------------


def test_jaccard_join(spark):
    got = jaccard_join.link(cases.documents(spark)).collect()
    assert cases.ordered(tuple(r) for r in got) == cases.jaccard_components(cases.plain(spark))


@pytest.mark.parametrize("longest", [6, 1000])
def test_jaccard_join_with_long_lists(spark, monkeypatch, longest):
    """Groups of near copies beyond a list's length, in several blocks."""
    import random

    rng = random.Random(3)
    rows, at = [], 0
    for group in range(2):
        base = [f"g{group}w{k}" for k in range(90)]
        for _ in range(60):
            w = list(base)
            for _ in range(rng.randint(0, 6)):
                w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
            rows.append((at, " ".join(w)))
            at += 1
    monkeypatch.setattr(jaccard_join, "LIST", longest)
    monkeypatch.setattr(jaccard_join, "CHUNK", 8)
    got = jaccard_join.link(cases.documents(spark, rows)).collect()
    assert cases.ordered(tuple(r) for r in got) == cases.jaccard_components(rows)


@pytest.mark.parametrize("boundary", [0, 6, 24])
def test_jaccard_join_at_any_boundary(spark, monkeypatch, boundary):
    import random

    rng = random.Random(boundary)
    rows = [(k, " ".join(f"w{j}" for j in range(rng.randint(0, 3), rng.randint(5, 22)) if rng.random() < 0.98)) for k in range(50)]
    monkeypatch.setattr(jaccard_join, "choose_boundary", lambda *_: boundary)
    got = jaccard_join.link(cases.documents(spark, rows)).collect()
    assert cases.ordered(tuple(r) for r in got) == cases.jaccard_components(rows)


def test_blocks_connect_what_all_links_connect():
    rng = np.random.default_rng(1)
    sets = [set(range(30)) - set(rng.integers(0, 30, 3).tolist()) for _ in range(40)] + [set(range(100 + k, 140 + k)) for k in range(0, 40, 3)]
    sizes = np.array([len(s) for s in sets])
    flat = np.array([x for s in sets for x in sorted(s)], dtype=np.int64)
    a, b = jaccard_join.linked_in_block(np.arange(len(sets)) * 10, flat, sizes, 80)
    assert len(a) < len(sets) and all(100 * len(sets[x // 10] & sets[y // 10]) >= 80 * len(sets[x // 10] | sets[y // 10]) for x, y in zip(a, b))
    group = {x * 10: x for x in range(len(sets))}
    find = lambda x: x if group[x] == x // 10 else find(group[x] * 10)
    for x, y in zip(a.tolist(), b.tolist()):
        group[find(y)] = find(x) // 10
    for x in range(len(sets)):
        for y in range(x):
            if 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y]):
                assert find(10 * x) == find(10 * y)


def test_boundary_follows_cost():
    assert jaccard_join.choose_boundary({4: (10, 1e9), 20: (10, 1.0)}, 80) >= 5
    assert jaccard_join.choose_boundary({n: (1000, 0.0) for n in range(1, 30)}, 80) == 0


def test_jaccard_join_of_an_empty_table(spark):
    assert jaccard_join.link(cases.documents(spark, [])).collect() == []


# --- 2 -------------------------------------------------------------------------


def test_statistics(spark):
    found = quality_rules.statistics(cases.documents(spark))
    got = quality_rules.judge(found, []).collect()
    expected = []
    for i, text in cases.plain(spark):
        w = [x.decode() for x in cases.words(text)]
        windows = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        covered = {k + j for k, x in enumerate(windows) if windows.count(x) > 1 for j in range(5)} if len(w) < 500 else set()
        lines, seen, dup = (text or "").split("\n"), set(), 0
        for line in lines:
            if cases.words(line):
                dup += line in seen
                seen.add(line)
        failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
        expected.append((i, len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(covered), failed, not failed))
    long = {i for i, t in cases.plain(spark) if len(cases.words(t)) >= 500}
    assert [r for r in cases.ordered(tuple(r) for r in got) if r[0] not in long] == [r for r in cases.ordered(expected) if r[0] not in long]


def _labelled(spark):
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 4))
    rows, labels = [], []
    for k in range(300):
        bad = k % 5 == 0
        rows.append((k, " ".join(word() + ("***" if bad and rng.random() < 0.8 else "") for _ in range(60)) + (" & co" if k % 7 == 0 else "")))
        labels.append((k, 0 if bad else 1))
    return cases.documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int")


def test_rules_are_learned_and_kept_to_the_bad_texts(spark):
    docs, labels = _labelled(spark)
    found = materialize(quality_rules.statistics(docs), "statistics")
    rules = quality_rules.fit(found, labels)
    assert 1 <= len(rules) <= 3 and rules[0][0].name == "symbols_per_word"
    kept = {r.doc_id: r.kept for r in quality_rules.judge(found, rules).collect()}
    assert all(kept[k] == (k % 5 != 0) for k in kept)
    good = quality_rules.keep_good(docs, rules)
    assert good.columns == docs.columns and good.count() == 240


def test_no_rules_without_labels_or_from_one_class(spark):
    docs, labels = _labelled(spark)
    found = quality_rules.statistics(docs)
    assert quality_rules.fit(found, labels.limit(0)) == []
    assert quality_rules.fit(found, labels.filter("quality = 1")) == []
    assert quality_rules.judge(quality_rules.statistics(cases.documents(spark, [])), []).collect() == []
