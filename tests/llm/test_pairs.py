"""SimHash, components, SpotSigs and decontamination against brute force."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from spendcast.llm import decontaminate, graph, simhash, spotsigs
from spendcast.llm.graph import components
from tests.helpers import final_plan
from tests.llm.helpers import documents, edited, prose

BASE = [prose(i, 60 + 3 * i) for i in range(30)]
NEAR = [edited(BASE[i % 10], 100 + i, 1) for i in range(30)]
ODD = [None, "", "   ", "one", "one two", "ONE two", "%%% !!!", BASE[0], BASE[0], "x" * 300_000, prose(9, 30_000)]


def plain_fingerprint(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(edges, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("edges_per_task", [10, 1 << 18])
def test_components_of_chains_stars_and_rings(spark, monkeypatch, edges_per_task):
    monkeypatch.setattr(graph, "EDGES_PER_TASK", edges_per_task)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, 1000 + i) for i in range(200)]
    ring = [(50, 51), (51, 52), (52, 50), (60, 60)]
    edges = chain[::-1] + star + ring + ring
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = groups([e for e in edges if e[0] != e[1]], {n for e in edges for n in e} - {60})
    assert found == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("many", [False, True])
def test_a_star_step_makes_one_edge_of_an_edge(spark, many):
    """By the definition of the two steps, and without rows in between that outnumber the edges."""
    rng = np.random.default_rng(4)
    edges = {(int(max(e)), int(min(e))) for e in rng.integers(0, 60, (150, 2)) if e[0] != e[1]} | {(i, 5) for i in range(60, 200)}
    around = {}
    for a, b in edges:
        around.setdefault(a, set()).add(b)
        around.setdefault(b, set()).add(a)
    large = {(n, min(u, *around[u])) for u in around for n in around[u] if n > u}
    small = {(n, min(ns)) for u in around if (ns := [n for n in around[u] if n < u]) for n in (*ns, u) if n != min(ns)}
    df = spark.createDataFrame(sorted(edges), "a long, b long")
    for step, want in ((graph._star(df, large=True, many=many), large), (graph._star(df, large=False, many=many), small)):
        found = step.collect()
        assert {tuple(r) for r in found} == want
        assert len(found) == len(want) <= len(edges)
        assert "Generate" not in final_plan(step)


def test_simhash_equals_brute_force(spark):
    texts = BASE + NEAR + ODD
    found = simhash.near_duplicates(documents(spark, [*texts, (None, BASE[1]), (None, "only here, no id")], "clash"))
    rows = found.collect()
    assert len(rows) == len(texts) + 2
    prints = [plain_fingerprint(t) for t in texts]
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    want = groups(pairs, range(len(texts)))
    for r in rows:
        if r["doc_id"] is not None:
            assert r["fingerprint"] == f"{prints[r['doc_id']]:016x}"
            assert r["component_id"] == want[r["doc_id"]]
    alone = {r["fingerprint"]: r["component_id"] for r in rows if r["doc_id"] is None}
    assert alone[f"{plain_fingerprint(BASE[1]):016x}"] == want[1]
    assert None in alone.values()
    assert len(set(want.values())) < len(texts) - 10


def test_manhattan_distance_of_popcounts_is_a_lower_bound(spark):
    rng = np.random.default_rng(0)
    a = rng.integers(-(2**63), 2**63 - 1, 2000)
    b = np.array([x ^ (1 << int(i)) if i < 63 else x for x, i in zip(a, rng.integers(0, 64, 2000))])
    df = spark.createDataFrame([(int(x), int(y)) for x, y in zip(a, b)] + [(int(x), int(y)) for x, y in zip(a, a[::-1])], "a long, b long")
    rows = df.select("a", "b", F.bit_count(simhash.popcounts("a").bitwiseXOR(simhash.popcounts("b"))).alias("l1")).collect()
    for r in rows:
        x, y = r["a"] & (1 << 64) - 1, r["b"] & (1 << 64) - 1
        l1 = sum(abs((x >> s & 3).bit_count() - (y >> s & 3).bit_count()) for s in range(0, 64, 2))
        assert r["l1"] == l1 <= (x ^ y).bit_count()


def test_cells_get_finer_as_fingerprints_get_more():
    def tested(count):
        """Pairs that meet in cells for each of so many random fingerprints."""
        r = simhash.untouched_bands(count, 4)
        return math.comb(4 + r, r) * count / 2 ** (1.5 * 32 * r / (4 + r))

    chosen = [simhash.untouched_bands(10**k, 4) for k in range(3, 13)]
    assert chosen == sorted(chosen) and chosen[0] == 2 and chosen[-1] > 6
    # Cells of two bands would test some 10^8 pairs for each of 10^12 fingerprints.
    assert all(tested(10**k) < 30_000 for k in range(3, 13))
    assert all(tested(10**k) < 30 for k in range(3, 7))


@pytest.mark.parametrize(("max_bits", "bands"), [(1, None), (3, None), (4, None), (7, None), (4, 3), (2, 8)])
def test_links_connect_all_pairs_within_the_distance(spark, max_bits, bands):
    rng = np.random.default_rng(max_bits)
    seeds = rng.integers(-(2**62), 2**62, 20)
    values = {int(s) for s in seeds}
    for _ in range(300):  # walks away from the seeds, some bits at a time
        v = int(rng.choice(sorted(values)))
        for bit in rng.integers(0, 62, rng.integers(1, max_bits + 3)):
            v ^= 1 << int(bit)
        values.add(v)
    values = sorted(values)
    links = simhash.links(spark.createDataFrame([(v,) for v in values], "fp long"), max_bits, bands).collect()
    near = [(x, y) for x in values for y in values if x < y and ((x ^ y) & (1 << 64) - 1).bit_count() <= max_bits]
    assert all(((r["a"] ^ r["b"]) & (1 << 64) - 1).bit_count() <= max_bits for r in links)
    assert groups([(r["a"], r["b"]) for r in links], values) == groups(near, values)


def test_a_dense_group_gives_few_links(spark):
    center = 0x123456789ABCDEF
    values = [center] + [center ^ (1 << i) for i in range(60)] + [center ^ (1 << i) ^ (1 << (i + 1)) for i in range(59)]
    links = simhash.links(spark.createDataFrame([(v,) for v in values], "fp long"), 4)
    assert links.distinct().count() < 16 * len(values) < len(values) * (len(values) - 1) / 2


def one_of_each_group(rows, max_bits=4):
    """Brute force: of each group of the rows with an id the least (id, md5 of the text); rows without an id all stay."""
    named = sorted({(i, t or "") for i, t in rows if i is not None})
    prints = [plain_fingerprint(t) for _, t in named]
    near = [(x, y) for x in range(len(named)) for y in range(x) if (prints[x] ^ prints[y]).bit_count() <= max_bits]
    root = groups(near, range(len(named)))
    least = {}
    for n, (i, t) in enumerate(named):
        found = (i, hashlib.md5(t.encode()).hexdigest(), t)
        least[root[n]] = min(least.get(root[n], found), found)
    return sorted([(i, t) for i, _, t in least.values()] + [(None, t or "") for i, t in rows if i is None], key=repr)


A, B = BASE[0], BASE[1]


@pytest.mark.parametrize(
    "texts",
    [
        [A, B, edited(A, 1, 0), (1, "zz other text with the same id"), (None, B), (None, B), "", None],
        [(1, A), (1, B), (5, B), (7, A)],  # two groups whose first documents share an id
        [A, *((i, t) for i in range(1, 13) for t in (A, BASE[i]))],
        [(3, A), (3, A), (3, A), (3, B), (2, BASE[2]), (2, B)],
    ],
)
def test_one_document_of_each_group_stays(spark, texts):
    df = documents(spark, texts, "clash")
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    assert sorted(((r["doc_id"], r["text"] or "") for r in kept.collect()), key=repr) == one_of_each_group(rows)
    assert simhash.drop_near_duplicates(df.limit(0)).count() == 0


def signatures(text):
    words = [w for w in re.split(r"[^\w]+|_", (text or "").lower()) if w]
    content = [w for w in words if w not in spotsigs.ANCHORS]
    out, k = set(), 0
    for p, w in enumerate(words):
        if w in spotsigs.ANCHORS:
            if len(content) >= p - k + 2:
                out.add((w, *content[p - k : p - k + 2]))
            k += 1
    if not out:
        if len(words) >= 2:
            return {tuple(words[i : i + 2]) for i in range(len(words) - 1)}
        return {tuple(words)} if words else {text} if text else set()
    return out


def jaccard(a, b):
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def test_spotsigs_equal_brute_force(spark):
    texts = BASE + NEAR + ODD[:-2] + ["é" * 7 + " the x", "日本 の"]
    found = {r["doc_id"]: r for r in spotsigs.compare_with_edits(documents(spark, texts, "clash"), parts=5).collect()}
    assert sorted(found) == list(range(len(texts)))
    sets = [signatures(t) for t in texts]
    for i, text in enumerate(texts):
        text, follows = text or "", texts[i - 1] or ""
        third = len(text) // 3
        new = text[: len(text) - third] + follows[:third]
        r = found[i]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        assert r["near_edited"] == pytest.approx(jaccard(sets[i], signatures(new)))
        assert r["near_next"] == pytest.approx(jaccard(sets[i], sets[i - 1]))
        assert spotsigs.fingerprint_likeness(r["fingerprint"], r["edited_fingerprint"]) == pytest.approx(r["near_edited"])
        assert spotsigs.fingerprint_likeness(r["fingerprint"], found[(i - 1) % len(texts)]["fingerprint"]) == pytest.approx(r["near_next"])
        for j in range(i):
            assert (r["fingerprint"] == found[j]["fingerprint"]) == (sets[i] == sets[j])


def test_spotsigs_edges(spark):
    one = spotsigs.compare_with_edits(documents(spark, ["the cat sat here"])).first()
    assert one["near_next"] == 1.0
    assert spotsigs.compare_with_edits(documents(spark, ["x"]).limit(0)).count() == 0
    same = spotsigs.compare_with_edits(documents(spark, [(5, "aaa"), (5, "bbb"), (None, "ccc"), (5, "aaa")])).collect()
    assert len(same) == 4
    sha = {hashlib.sha256(t.encode()).hexdigest() for t in ("bba", "aaa", "aac", "ccb")}
    assert {r["edited_sha256"] for r in same} == sha


def test_spotsig_pairs_equal_brute_force(spark):
    one_id = [(1, BASE[0]), (1, BASE[1]), (5, BASE[1]), (7, BASE[0]), (None, BASE[1])]
    pairs, members = spotsigs.near_pairs(documents(spark, one_id))
    assert pairs.count() == 0
    found = {(r["doc_id"], r["class"], r["set"]) for r in members.collect()}
    assert {(i, c) for i, c, _ in found} == {(1, 1), (5, 1), (7, 1)}
    assert len(found) == 4 and len({s for _, _, s in found}) == 2
    texts = BASE + NEAR + [BASE[3], BASE[3]] + ["", "one"]
    pairs, members = spotsigs.near_pairs(documents(spark, texts), min_likeness=0.8)
    sets = [frozenset(signatures(t)) for t in texts]
    first = {}
    for i, s in enumerate(sets):
        first.setdefault(s, i)
    assert {(r["doc_id"], r["class"]) for r in members.collect()} == {(i, first[s]) for i, s in enumerate(sets)}
    classes = [(i, s) for s, i in first.items() if s]
    want = {(i, j): jaccard(s, t) for i, s in classes for j, t in classes if i < j and jaccard(s, t) >= 0.8}
    assert {(r["a"], r["b"]): r["likeness"] for r in pairs.collect()} == pytest.approx(want)
    assert len(want) > 5


def contaminated(texts, items):
    def words(t):
        return [w for w in re.split(r"[^\w]+|_", (t or "").lower()) if w]

    found = {}
    for i, item in items:
        w = words(item)
        if not w:
            continue
        k = min(5, len(w))
        own = Counter(tuple(w[a : a + k]) for a in range(len(w) - k + 1))
        size = len(w) - k + 1
        for d, text in enumerate(texts):
            v = words(text)
            all_of = [tuple(v[a : a + k]) for a in range(len(v) - k + 1)]
            best = 0.0
            for a in range(max(1, len(all_of) - size + 1)):
                window = Counter(all_of[a : a + size])
                best = max(best, (own & window).total() / (own | window).total())
            if best >= 0.8:
                found[d, i] = best
    return found


ITEMS = [(i, prose(1000 + i, 18 + 2 * i, 5000)) for i in range(12)] + [(90, "tiny item here"), (91, ""), (92, None), (93, prose(1003, 24, 5000))]


def leaky():
    texts = []
    for i in range(40):
        passage = edited(ITEMS[i % 12][1], i, i % 4 and 1) if i % 4 else ITEMS[i % 12][1].upper()
        cover = prose(500 + i, 80).split(" ")
        words = passage.split(" ")
        passage = " ".join(words[i % 3 :]) + " " + " ".join(words[: i % 3])
        at = (0, 40, 80)[i % 3]
        texts.append(" ".join([*cover[:at], passage.replace(" ", ", ", 3), *cover[at:]]))
    return texts + ["Tiny item, here!", None, "", "the", ITEMS[2][1], "a b " * 20_000]


def test_decontamination_equals_brute_force(spark):
    texts = leaky()
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = decontaminate.contaminated(documents(spark, texts, "clash"), benchmark)
    want = contaminated(texts, ITEMS)
    assert {(r["doc_id"], r["item_id"]): r["similarity"] for r in found.collect()} == pytest.approx(want)
    assert len(want) > 10 and any(s < 1 for s in want.values())
    assert "Python" not in final_plan(found) and "Arrow" not in final_plan(found)


def test_decontamination_without_broadcast_is_the_same(spark, monkeypatch):
    texts = leaky()
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    found = decontaminate.contaminated(documents(spark, texts), benchmark)
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == set(contaminated(texts, ITEMS))


def test_blocks_reach_every_fingerprint_within_the_distance():
    rng = np.random.default_rng(1)
    cuts = decontaminate._blocks(23, 6)
    assert sum((mask + 1).bit_length() - 1 for _, mask, _ in cuts) == 64
    for _ in range(500):
        bits = rng.choice(64, 23, replace=False)
        differ = sum(1 << int(b) for b in bits)
        assert any((differ >> low & mask) in flips for low, mask, flips in cuts)


def test_contaminated_documents_go(spark):
    texts = [*leaky(), (None, ITEMS[0][1]), (None, "clean"), (0, "clean with a used id")]
    df = documents(spark, texts, "clash")
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = decontaminate.decontaminate(df, benchmark)
    assert kept.columns == df.columns
    dirty = {d for d, _ in contaminated(leaky(), ITEMS)}
    want = [t for i, t in enumerate(leaky()) if i not in dirty] + ["clean", "clean with a used id"]
    assert sorted(str(r["text"]) for r in kept.collect()) == sorted(map(str, want))
    assert decontaminate.decontaminate(df, benchmark.limit(0)).count() == df.count()
    assert decontaminate.decontaminate(df.limit(0), benchmark).count() == 0
