"""Toxicity, line dedup, suffix dedup, BPE and token counts against brute force or an exact round trip."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spendcast.llm import bpe, lines, separators, suffixes, toxicity
from tests.helpers import final_plan
from tests.llm.helpers import documents, prose

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
TIKTOKEN = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


# Toxicity


def labelled(spark, count=240):
    rnd = random.Random(3)
    texts, labels = [], []
    for i in range(count):
        words = prose(i, rnd.randrange(20, 120)).split(" ")
        toxic = i % 4 == 0
        if toxic:
            for _ in range(4):
                words[rnd.randrange(len(words))] = rnd.choice(["zorgle", "blorpen", "idiot"]) + rnd.choice(["", "ei", "os"])
        texts.append(" ".join(words))
        labels.append((i, 1, int(toxic)))
    return texts, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_on_held_out_rows(spark):
    texts, labels = labelled(spark)
    rows = [*texts, (None, texts[0]), (5000, None), (5001, ""), (5002, texts[4]), (5002, texts[4]), (5003, "Z" * 200_000)]
    df = documents(spark, rows, "clash")
    model = toxicity.fit_toxicity(df, labels.union(labels.limit(20)))
    scored = toxicity.score_toxicity(df, model)
    assert scored.columns == [*(c for c in df.columns if c != "score"), "score"]
    found = scored.select("doc_id", "score", toxicity.held_out().alias("h")).collect()
    assert len(found) == len(rows) and all(0 <= r["score"] <= 1 for r in found)
    hidden = [r for r in found if r["h"] and r["doc_id"] is not None and r["doc_id"] < len(texts)]
    right = sum((r["score"] >= 0.7) == (r["doc_id"] % 4 == 0) for r in hidden)
    assert len(hidden) > 50 and right / len(hidden) > 0.9
    same = [r["score"] for r in found if r["doc_id"] in (4, 5002)]
    assert len(same) == 3 and len(set(same)) == 1
    empty = {r["doc_id"]: r["score"] for r in found if r["doc_id"] in (5000, 5001)}
    assert empty[5000] == empty[5001]
    kept = toxicity.drop_toxic(df, labels)
    assert kept.columns == df.columns
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert len(ids & {i for i in range(len(texts)) if i % 4}) > 0.95 * 180


def plain_features(text, words, stems):
    """The twelve features in the order of their names, counted word by word."""
    read = text.lower().translate(str.maketrans(*toxicity.LOOKALIKES))
    found = regex.split(r"[^\p{L}]+", read)
    count = max(sum(w != "" for w in found), 1)
    fixed = sum(w in toxicity.INSULTS for w in found)
    second = sum(w in toxicity.SECOND_PERSON for w in found)
    hits = [i for i, w in enumerate(found) if w in toxicity.INSULTS or w in words or any(w[:n] in stems[n] for n in stems)]
    # Seven words that begin three before the hit, or with the first word.
    near = sum(any(v in toxicity.SECOND_PERSON for v in found[max(i - 3, 0) :][:7]) for i in hits)
    chars = max(len(text), 1)
    of = [len(regex.findall(p, text)) for p in (r"\p{Lu}", r"\p{Lu}{3,}", r"\p{P}", r"\p{L}[0-9@$*]+\p{L}", r"(\p{L})\1{2,}")]
    return [
        fixed / count, len(hits) / count, len(hits), second / count, near / count, of[0] / chars, of[1] / count,
        of[2] / chars, text.count("!") / chars, of[3] / count, of[4] / count, np.log1p(sum(w != "" for w in found)),
    ]


def test_features_equal_brute_force(spark):
    rnd = random.Random(11)
    pieces = ["you", "tu", "vous", "idiot", "1d10t", "ZORGLE", "zorgleos", "HEING,!!", "THE!!", "sh1t", "sooo", "l0ser,", "word", "Größe", "été", "a-b", "x2y", "$tupid"]
    texts = ["", " ", "!!!", "idiot you", "you a b c d e idiot", "idiot a b c d you", "x" * 50_000, "ÀÉÎ ÕÜÇ aaa bbbB"]
    texts += [" ".join(rnd.choice(pieces) for _ in range(rnd.randrange(1, 40))) for _ in range(150)]
    words, stems = ("blorpen", "word"), {4: ("zorg",), 5: (), 6: ("größen",)}
    df = spark.createDataFrame(list(enumerate(texts)), "n int, tox_text string")
    rows = {r["n"]: r for r in toxicity._features(df, words, stems).collect()}
    for n, text in enumerate(texts):
        found = [rows[n][f"tox_{name}"] for name in toxicity.FEATURES]
        assert found == pytest.approx(plain_features(text, words, stems)), text[:80]


def test_held_out_rows_have_no_part_in_the_fit(spark):
    texts, labels = labelled(spark, 60)
    df = documents(spark, texts)
    hidden = toxicity.held_out()
    turned = labels.withColumn("toxic", F.when(hidden, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.score_toxicity(df, toxicity.fit_toxicity(df, t)).select("doc_id", "score") for t in (labels, turned))
    assert sorted(a.collect()) == sorted(b.collect())


def test_toxicity_without_two_classes(spark):
    df = documents(spark, ["a b", "c d", "", None])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(4)], "doc_id long, quality int, toxic int")
    for some in (labels, labels.limit(0)):
        scored = toxicity.score_toxicity(df, toxicity.fit_toxicity(df, some))
        assert [r["score"] for r in scored.collect()] == [0.0] * 4
    model = toxicity.fit_toxicity(df.limit(0), labels)
    assert toxicity.score_toxicity(df.limit(0), model).count() == 0


# Line dedup


def deduped(rows, min_lines=2, min_words=50):
    """rows in the order in which copies count."""
    single, run, out = {}, {}, []
    for n, text in enumerate(rows):
        all_lines = (text or "").split("\n")
        places = [i for i, line in enumerate(all_lines) if line.strip(" ")]
        gone = set()
        for s, i in enumerate(places):
            line = all_lines[i]
            if single.setdefault(line, (n, s)) != (n, s) and len(re.findall(r"[^\x20\x09-\x0D]+", line)) >= min_words:
                gone.add(s)
            window = tuple(all_lines[p] for p in places[s : s + min_lines])
            if len(window) == min_lines and run.setdefault(window, (n, s)) != (n, s):
                gone |= set(range(s, s + min_lines))
        cut = {places[s] for s in gone}
        cut |= {i for s in gone if s + 1 in gone for i in range(places[s], places[s + 1])}
        out.append("\n".join(line for i, line in enumerate(all_lines) if i not in cut))
    return out


def line_texts():
    rnd = random.Random(8)
    pool = [f"line {i}" for i in range(25)] + ["", " ", prose(1, 60), prose(2, 49)]
    texts = ["\n".join(rnd.choice(pool) for _ in range(rnd.randrange(1, 14))) for _ in range(60)]
    long = "\n".join(f"row {i}" for i in range(700))
    return texts + [long, "x\n" + long + "\ny", texts[0], "", None, "a\na\na\na", "\n\n\n", prose(1, 60), prose(2, 49), prose(2, 49)]


@pytest.mark.parametrize("min_lines", [2, 3, 5])
def test_line_dedup_equals_brute_force(spark, min_lines):
    texts = line_texts()
    df = documents(spark, [*texts, (None, texts[0]), (3, texts[3])], "clash")
    cut = lines.dedup_lines(df, min_lines=min_lines)
    assert cut.columns == df.columns
    rows = cut.collect()
    assert "Python" not in final_plan(cut) and "Arrow" not in final_plan(cut)
    want = deduped(texts, min_lines)
    for i, text in enumerate(want):
        found = [r for r in rows if r["doc_id"] == i]
        assert len(found) == (2 if i == 3 else 1)
        for r in found:
            assert (r["text"] or "") == text
            assert (r["n_chars"] or 0) == len(text)
    assert [r["text"] for r in rows if r["doc_id"] is None] == [texts[0]]


def test_line_dedup_edges(spark):
    df = documents(spark, ["a\nb", "a\nb"])
    assert lines.dedup_lines(df.limit(0)).count() == 0
    report = lines.dedup_lines(df.withColumn("n_lines", F.lit("x")), report=True).orderBy("doc_id").collect()
    assert [(r["n_lines"], r["n_removed"], r["n_runs"], r["text"]) for r in report] == [(2, 0, 0, "a\nb"), (2, 2, 1, "")]
    with pytest.raises(ValueError):
        lines.repeated_runs(df, min_lines=1)


# Suffix dedup


def uncovered(rows, length):
    """rows: (id, bytes). For each the bytes kept, how many go and in how many runs."""
    first: dict[bytes, int] = {}
    for i, data in rows:
        if i is not None:
            for k in range(len(data) - length + 1):
                w = data[k : k + length]
                first[w] = min(first.get(w, i), i)
    out = []
    for i, data in rows:
        gone = bytearray(len(data))
        for k in range(len(data) - length + 1) if i is not None else ():
            if first[data[k : k + length]] < i:
                gone[k : k + length] = b"\1" * length
        kept = bytes(c for c, g in zip(data, gone) if not g)
        runs = sum(1 for k, g in enumerate(gone) if g and (not k or not gone[k - 1]))
        out.append((i, kept, len(data), sum(gone), runs))
    return sorted(out, key=repr)


def passages():
    rnd = random.Random(4)
    base = [prose(i, 120) + " é日本" for i in range(12)]
    out = list(base)
    for i in range(80):
        text, size = rnd.choice(base), rnd.choice([48, 49, 50, 51, 70, 200])
        at = rnd.randrange(len(text) - size)
        out.append(f"q{rnd.randrange(10**9)}z{text[at : at + size]}w{rnd.randrange(10**9)}")
    odd = ["%" * 300, "%" * 90, "ab" * 120, "ba" * 60, "", None, "z" * 49, "z" * 50, "z" * 50, base[0], base[0] + base[1]]
    return out + odd


def test_suffix_dedup_equals_brute_force(spark):
    texts = passages()
    rows = [*enumerate(texts), (None, texts[0]), (2, "x" + texts[3]), (-5, texts[7][10:90])]
    df = documents(spark, rows, "clash").repartition(5)
    found = suffixes.remove_repeats(df, length=50, parts=7)
    assert found.columns == [*(c for c in df.columns if c not in ("text", "kept")), "kept"]
    got = sorted(((r["doc_id"], *map(lambda v: bytes(v) if isinstance(v, bytearray) else v, r["kept"])) for r in found.collect()), key=repr)
    assert got == uncovered([(i, (t or "").encode()) for i, t in rows], 50)


@pytest.mark.parametrize(("length", "q"), [(9, 8), (33, 16), (64, 24)])
def test_suffix_dedup_of_other_depths(spark, length, q):
    texts = passages()[:60]
    found = suffixes.remove_repeats(documents(spark, texts), length=length, q=q, parts=3)
    got = sorted(((r["doc_id"], *map(lambda v: bytes(v) if isinstance(v, bytearray) else v, r["kept"])) for r in found.collect()), key=repr)
    assert got == uncovered([(i, (t or "").encode()) for i, t in enumerate(texts)], length)


def test_long_texts_are_cut_into_overlapping_pieces(monkeypatch):
    data = " ".join(prose(i, 50) for i in range(10)).encode()
    whole = suffixes.Pieces([(0, 0, data)], 50, 24)
    want = set(zip(*(a.tolist() for a in whole.refined(whole.strings(np.arange(len(whole.start)))[0]))))
    monkeypatch.setattr(suffixes, "PIECE", 300)
    found, places = set(), []
    for p in suffixes._scan([(0, data)], 50, 24):
        at, run = p.strings(np.arange(len(p.start)))
        found |= set(zip(*(a.tolist() for a in p.refined(at))))
        places += (at - p.first[p.piece[run]] + p.base[p.piece[run]]).tolist()
    assert found == want
    assert sorted(places) == list(range(len(data) - 49))


def test_suffix_dedup_edges(spark):
    df = documents(spark, ["x" * 60, None])
    assert suffixes.remove_repeats(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        suffixes.remove_repeats(df, length=50, q=20)


# Byte-level BPE

PIECES = st.sampled_from(["'", "s", "re", "ll", "m", "x", "É", "1", "²", " ", "  ", "\n", "\t", "\r\n", "!", "…", "日本", "😀", "-", "'ve", "́"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(PIECES, max_size=14).map("".join), min_size=1, max_size=4))
def test_words_are_those_of_the_pattern(texts):
    words, at = bpe.split_texts([t.encode() for t in texts], bpe.SPLIT)
    words = [w.decode() for w in words.to_pylist()]
    assert [words[a:b] for a, b in zip(at, at[1:])] == [regex.findall(bpe.SPLIT, t) for t in texts]


def test_the_pattern_is_the_public_one():
    assert bpe.SPLIT == public_tokenizers.PATTERN


@pytest.mark.parametrize("size", [1, 5, 64, 65, 300, 4000])
def test_merges_of_one_word(size):
    rnd = random.Random(size)
    pool = list(RANKS)
    for _ in range(20):
        word = b"".join(rnd.choice(pool) for _ in range(size))[:size]
        assert bpe.merge_word(word, RANKS) == TIKTOKEN._core_bpe.encode_single_piece(word)


def bpe_texts():
    return [prose(1, 300), "Hello  world\n\n  x 123 …日本語テキスト don't it's", "", None, "a" * 3000 + " " * 500 + "   x", "😀" * 200, prose(2, 20_000), prose(1, 300)]


@pytest.mark.parametrize("size", [0, 3, 1 << 19])
def test_bpe_equals_tiktoken_and_round_trips(spark, size):
    df = documents(spark, bpe_texts(), "clash").withColumn("token_bytes", F.lit("old"))
    coded = bpe.encode(df, RANKS, public_tokenizers.PATTERN, dictionary_size=size, decoded="fp")
    assert sorted(coded.columns) == sorted(df.columns)
    for r in coded.collect():
        assert bytes(r["fp"]).decode() == (r["text"] or "") and r["score"] == "score"
    for r in coded.select("text", bpe.token_ids(F.col("token_bytes")).alias("ids"), bpe.decode(F.col("token_bytes"), RANKS, spark).alias("back")).collect():
        assert list(r["ids"]) == TIKTOKEN.encode_ordinary(r["text"] or "")
        assert bytes(r["back"]).decode() == (r["text"] or "")


def test_folded_merges_equal_the_helper(spark):
    words = sorted({w for t in bpe_texts() for w in regex.findall(bpe.SPLIT, t or "") if len(w.encode()) <= bpe.LONGEST})[:300]
    df = spark.createDataFrame([(w, w.encode().hex()) for w in words], "w string, h string")
    for r in df.select("w", bpe.fold_merges(F.col("h"), RANKS).alias("ids")).collect():
        assert r["ids"] == bpe.merge_word(r["w"].encode(), RANKS)


def test_bpe_with_another_pattern(spark):
    df = documents(spark, ["ab cd  ef", None])
    coded = bpe.encode(df, RANKS, r"\S+|\s+")
    other = tiktoken.Encoding("x", pat_str=r"\S+|\s+", mergeable_ranks=RANKS, special_tokens={})
    got = [list(r[0]) for r in coded.orderBy("doc_id").select(bpe.token_ids(F.col("token_bytes"))).collect()]
    assert got == [other.encode_ordinary("ab cd  ef"), []]
    assert bpe.encode(df.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_decoding_edges(spark):
    df = spark.createDataFrame([(None,), (b"",), (b"\xff\xff\xff\x00",)], "b binary")
    back = df.where("b is null or length(b) = 0").select(bpe.decode(F.col("b"), RANKS, spark).alias("x"))
    assert sorted((None if r["x"] is None else bytes(r["x"]) for r in back.collect()), key=repr) == [None, b""]
    with pytest.raises(Exception, match="no piece"):
        df.select(bpe.decode(F.col("b"), RANKS, spark)).collect()


# Token counts


@pytest.mark.parametrize("block", [6, 1000, 1 << 20])
def test_token_counts_equal_the_encoder(spark, block):
    texts = [prose(i, 30) for i in range(12)] + ["", None, "", prose(3, 2000)]
    df = documents(spark, [*texts, (None, "no id"), (1, texts[1])], "clash").repartition(3)
    encoder = separators.BpeEncoder(RANKS, public_tokenizers.PATTERN)
    found = separators.document_token_counts(df, encoder, 50256, block_bytes=block)
    want = Counter((i, len(TIKTOKEN.encode_ordinary(t or ""))) for i, t in [*enumerate(texts), (None, "no id"), (1, texts[1])])
    assert Counter(tuple(r) for r in found.collect()) == want
    assert separators.document_token_counts(df.limit(0), encoder, 50256).count() == 0


@pytest.mark.parametrize("width", [2, 4])
@pytest.mark.parametrize("block", [4, 8, 20, 1 << 20])
def test_separator_scan_equals_a_plain_scan(spark, tmp_path, monkeypatch, width, block):
    monkeypatch.setattr(separators, "STRETCH", 3)  # several stretches
    rng = np.random.default_rng(width + block)
    want = set()
    for name, size in (("a", 0), ("b", 1), ("c", 97), ("d", 200)):
        ids = rng.choice([7, 7, 9], size).astype(f"<u{width}")
        if name == "c":
            ids[:] = 7  # no separator at all
        ids.tofile(tmp_path / f"{name}.bin")
        start = 0
        stops = [*np.flatnonzero(ids == 9).tolist()]
        for n, stop in enumerate(stops):
            want.add((f"{name}.bin", n, start, stop - start, True))
            start = stop + 1
        if start < size:
            want.add((f"{name}.bin", len(stops), start, size - start, False))
    files = separators.token_files(spark, str(tmp_path))
    found = separators.count_tokens(files, 9, width=width, block_bytes=block).collect()
    assert {(r["file"].rsplit("/", 1)[1], r["ordinal"], r["start"], r["n_tokens"], r["ended"]) for r in found} == want
    assert len(found) == len(want)


def test_part_of_an_id_is_an_error(spark, tmp_path):
    (tmp_path / "x.bin").write_bytes(b"abc")
    with pytest.raises(Exception, match="part of an id"):
        separators.count_tokens(separators.token_files(spark, str(tmp_path)), 9).collect()


