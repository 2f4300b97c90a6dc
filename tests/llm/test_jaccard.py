"""Near-duplicate documents of the pipeline, against all pairs."""

from collections import Counter

import numpy as np

from snapledger.llm import jaccard, simhash, stages
from snapledger.llm.common import ready

from .frames import documents, prose, sf


def slow_shingles(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", words) if w]
    return frozenset(" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def slow_groups(texts):
    """Root of each text, by all pairs that share a shingle."""
    sets, where = [slow_shingles(t) for t in texts], {}
    parent = list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    n_pairs = 0
    for i, own in enumerate(sets):
        shared = Counter(j for s in own for j in where.get(s, ()))
        if not own:
            shared = {j: 0 for j in range(i) if not sets[j]}
        for j, n in shared.items():
            if 5 * n >= 4 * (len(own) + len(sets[j]) - n):
                n_pairs += n < len(own) + len(sets[j]) - n
                a, b = sorted((find(i), find(j)))
                parent[b] = a
        for s in own:
            where.setdefault(s, []).append(i)
    return [find(i) for i in range(len(texts))], n_pairs


def kept(spark, rows):
    docs = documents(spark, rows).selectExpr("*", "cast(length(text) as long) n_chars").repartition(3)
    return sorted((r.doc_id, r.text) for r in stages.near_duplicates(spark, docs, "").collect())


def edited(base, at):
    words = base.split()
    for k in at:
        words[k] = f"changed{k}"
    return " ".join(words)


def test_changed_words_are_near_duplicates(spark):
    """A word in the middle costs five of 196 shingles on either side: 191 / 201, 186 / 206,
    and with four changes 176 / 216, under four fifths by no more than one of them undone."""
    base = prose(3, 200)
    rows = [(0, base), (1, edited(base, [50])), (2, edited(base, [20, 90])), (3, prose(4, 200)),
            (4, edited(base, [10, 40, 70, 100, 130, 160]))]
    roots, n_pairs = slow_groups([t for _, t in rows])
    assert roots == [0, 0, 0, 3, 4] and n_pairs == 3
    assert [d for d, _ in kept(spark, rows)] == [0, 3, 4]


def test_whole_table_against_all_pairs(spark):
    docs = sf(spark, size="0.01").select(stages.COLUMNS)
    rows = sorted(map(tuple, docs.select("doc_id", "text").collect()))
    roots, n_pairs = slow_groups([t for _, t in rows])
    found = sorted(r.doc_id for r in stages.near_duplicates(spark, docs, "").collect())
    assert found == [rows[i][0] for i in range(len(rows)) if roots[i] == i]
    assert n_pairs


def test_crowded_keys(spark, monkeypatch):
    """Copies with one changed word each, and a chain of texts that only neighbours link, in
    tiles of few sets."""
    monkeypatch.setattr(jaccard, "TILE", 8)
    base, chain = prose(3, 150), prose(7, 300).split()
    rows = [(k, edited(base, [k])) for k in range(100)]
    rows += [(200 + k, " ".join(chain[8 * k:8 * k + 150])) for k in range(15)]
    roots, _ = slow_groups([t for _, t in rows])
    assert [d for d, _ in kept(spark, rows)] == [rows[i][0] for i in range(len(rows)) if roots[i] == i]


def test_templates_share_keys_but_no_links(spark, monkeypatch):
    """Texts with a common long passage, and among them some copies with changes: the keys of
    the passage are crowded, the rest is found where rare shingles meet."""
    monkeypatch.setattr(jaccard, "TILE", 10)
    shared = prose(3, 120)
    rows = [(k, f"{shared} {' '.join(f'own{k}x{i}' for i in range(40))}") for k in range(120)]
    rows += [(300 + k, edited(rows[7 * k][1], [150 + k % 5, 20])) for k in range(12)]
    roots, n_pairs = slow_groups([t for _, t in rows])
    assert n_pairs >= 12 and len(set(roots)) == 120
    sent = []
    compare = jaccard._Search.compare
    monkeypatch.setattr(jaccard._Search, "compare", lambda self, tiles, name: (
        sent.append((name, tiles.count())), compare(self, tiles, name)))
    assert [d for d, _ in kept(spark, rows)] == [rows[i][0] for i in range(len(rows)) if roots[i] == i]
    assert any(name.startswith("rare") for name, _ in sent)
    assert sum(n for _, n in sent) < 6 * len(rows)


def test_operator_1_searches_first(spark, monkeypatch):
    """Near copies within reach of the fingerprint index are compared because it links them, and leave
    nothing to the keys; one beyond its reach is found by keys.  A link of the index is checked."""
    base = prose(3, 400)
    near, far = edited(base, [200]), edited(base, range(20, 380, 25))
    loop = "to be or not to be is the question " * 60
    rows = [(0, base), (1, near), (2, prose(4, 200)), (3, loop + "that is all"), (4, loop + "and so on it goes")]
    bits = [simhash.fingerprint(t.encode()) for t in (base, near, far, rows[3][1], rows[4][1])]
    assert (bits[0] ^ bits[1]).bit_count() <= jaccard.DISTANCE < (bits[0] ^ bits[2]).bit_count()
    assert (bits[3] ^ bits[4]).bit_count() <= jaccard.DISTANCE
    sent = []
    compare = jaccard._Search.compare
    monkeypatch.setattr(jaccard._Search, "compare", lambda self, tiles, name: (
        sent.append((name, tiles.count())), compare(self, tiles, name)))
    assert [d for d, _ in kept(spark, rows[:3])] == [0, 2] and sent == [("alike", 2)]
    sent.clear()
    roots, _ = slow_groups([t for _, t in rows])
    assert roots == [0, 0, 2, 3, 4] and [d for d, _ in kept(spark, rows)] == [0, 2, 3, 4]
    assert sent[0] == ("alike", 4)
    sent.clear()
    rows = [(0, base), (1, edited(base, [40, 90, 140, 190, 240, 290, 340])), (2, far)]
    roots, _ = slow_groups([t for _, t in rows])
    assert [d for d, _ in kept(spark, rows)] == [i for i in range(3) if roots[i] == i]


def test_one_row_of_each_group(spark):
    """Repeated rows, an id in two groups, and rows without an id."""
    a, b, c, d = (prose(k, 80) for k in (3, 4, 7, 11))
    rows = [(1, a), (1, a), (5, a), (0, b), (5, b), (5, c), (5, c), (None, a), (None, c), (None, d),
            (None, d), (2, None), (3, " "), (None, "")]
    docs = documents(spark, rows).selectExpr("*", "cast(length(text) as long) n_chars").repartition(3)
    found = stages.near_duplicates(spark, docs, "").collect()
    assert sorted(((r.doc_id, r.text) for r in found), key=str) == sorted(
        [(1, a), (0, b), (5, c), (None, d), (2, None)], key=str)


def test_connected_agrees_with_all_pairs():
    rng = np.random.default_rng(5)
    sets = []
    for _ in range(12):
        centre = rng.integers(0, 1 << 62, 60, dtype=np.uint64)
        sets += [np.unique(np.where(rng.random(60) < rng.random() * 0.2, rng.integers(
            0, 1 << 62, 60, dtype=np.uint64), centre)) for _ in range(8)]
    label = jaccard.connected(sets, np.arange(len(sets)))
    want = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            n = len(np.intersect1d(a, b))
            if 5 * n >= 4 * (len(a) + len(b) - n):
                want = [want[j] if x == want[i] else x for x in want]
    assert [[x == y for y in want] for x in want] == [[x == y for y in label] for x in label]
    assert 12 < len(set(want)) < len(sets)
