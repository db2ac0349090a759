import numpy as np
import pytest
import xxhash

from seqscore.llm.components import connected_components
from seqscore.llm.simhash import fingerprint_links, keep_first, near_duplicates


def print_of(text, k=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    k = min(k, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + k]), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, pairs):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fingerprints_and_components(docs_of):
    rng = np.random.default_rng(0)
    words = [f"w{i}" for i in range(60)]
    base = " ".join(rng.choice(words, 80))
    texts = [base, base, base.upper(), base + " tail", base.replace("w1 ", "W1 "), "", None, " \t\n", "one", "two words",
             "ÀB cd ef", "àb cd ef", *(" ".join(rng.choice(words, 30)) for _ in range(30))]
    texts += [t + " x" for t in texts[-10:]]
    rows = [(i * 3 % 101, t) for i, t in enumerate(texts)]
    got = near_duplicates(docs_of([(a, b, "f", 1) for a, b in rows],
                                  "doc_id long, text string, f string, fingerprint int")).collect()
    prints = {k: print_of(t) for k, t in rows}
    near = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    want = components(prints, near)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {
        k: (f"{prints[k]:016x}", want[k]) for k in prints}
    assert len(got) == len(rows)


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_links_connect_what_brute_force_connects(spark, distance):
    rng = np.random.default_rng(distance)
    centres = rng.integers(0, 2**63, 6)
    prints = {0, -1, 1 << 62}
    for c in centres:
        for _ in range(12):
            for b in rng.choice(63, rng.integers(0, 5), replace=False):
                c = int(c) ^ (1 << int(b))
            prints.add(int(c))
    prints = sorted(prints)
    df = spark.createDataFrame([(p,) for p in prints], "f long")
    links = [(r.a, r.b) for r in fingerprint_links(df, "f", distance).collect()]
    mask = (1 << 64) - 1
    assert all(0 < ((a ^ b) & mask).bit_count() <= distance for a, b in links)
    near = [(a, b) for a in prints for b in prints if a < b and ((a ^ b) & mask).bit_count() <= distance]
    assert components(prints, links) == components(prints, near)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(8, 30)] + [(29, 3), (3, 3), (3, None)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in connected_components(df).collect()}
    assert got == {**{i: 100 for i in range(100, 141)}, **{i: 3 for i in [3, *range(7, 30)]}}
    assert connected_components(df.limit(0)).collect() == []


def test_repeated_and_missing_ids(docs_of):
    df = docs_of([(5, "a b c d"), (5, "a b c d"), (None, "a b c d"), (9, "A B C D"), (None, "x y z")])
    got = sorted(((r.doc_id, r.component_id) for r in near_duplicates(df).collect()), key=str)
    assert got == sorted([(5, 5), (5, 5), (None, 5), (9, 5), (None, None)], key=str)


def test_keep_first(docs_of):
    df = docs_of([(4, "a b c d", "x"), (2, "a b c d", "y"), (2, "a b c d", "y"), (7, "other text here now", "z")],
                 "doc_id long, text string, component_id string")
    kept = keep_first(df)
    assert kept.columns == ["doc_id", "text", "component_id"]
    assert sorted(r.doc_id for r in kept.collect()) == [2, 2, 7]
    assert keep_first(df.limit(0)).collect() == []
    assert near_duplicates(df.limit(0)).collect() == []


def test_keep_first_decides_by_row(docs_of):
    one, two = "a b c d", "other text here now"
    rows = [(5, one, "a"), (None, one, "b"), (None, "x y z", "c"), (None, "p q r s", "d"), (None, "p q r s", "e"),
            (9, one, "f"), (9, two, "g"), (12, two, "h"), (20, "k l m n", "i"), (20, "k l m n", "j")]
    df = docs_of(rows, "doc_id long, text string, name string")
    want = {frozenset("a"), frozenset("c"), frozenset("de"), frozenset("g"), frozenset("ij")}
    for repeats in (False, True):
        kept = [r.name for r in keep_first(df, repeats=repeats).collect()]
        got = [next(w for w in want if n in w) for n in kept if any(n in w for w in want)]
        assert len(got) == len(kept) and set(got) == want
        assert len(kept) == (6 if repeats else 5)
