"""Sharding, mixing, fingerprints and near duplicates."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from trailmark.llm import imatch, mixing, neardup, sharding

from .conftest import PLAIN, TEXTS, doc
from .test_scans import words


def varied(n, seed, size=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    return [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, size))) for _ in range(n)]


def test_shards_have_equal_bytes_and_gapless_slots(frame):
    texts = varied(600, 1) + ["same text again"] * 300
    got = sharding.op6_query(frame([doc(i, t) for i, t in enumerate(texts)])).toPandas().set_index("doc_id")
    assert sorted(got.index) == list(range(len(texts)))
    for i, t in enumerate(texts):
        raw = t.encode()
        assert (got.at[i, "size"], got.at[i, "text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
    sizes = got.groupby("shard")["size"].sum()
    assert sorted(sizes.index) == list(range(8))
    assert sizes.max() - sizes.min() <= 0.06 * sizes.mean() + 2 * got["size"].max()
    for _, slots in got.groupby("shard")["slot"]:
        assert sorted(slots) == list(range(len(slots)))


def test_small_groups_stay_in_one_shard(frame):
    texts = varied(800, 2) * 2
    got = sharding.op6_query(frame([doc(i, t) for i, t in enumerate(texts)])).toPandas()
    assert got.groupby("text_crc32")["shard"].nunique().max() == 1


def test_one_text_may_fill_everything(frame):
    got = sharding.op6_query(frame([doc(i, "one text for all") for i in range(400)])).toPandas()
    assert got.groupby("shard").size().tolist() == [50] * 8


def test_shards_of_odd_rows(odd, empty):
    got = sharding.op6_query(odd).toPandas()
    assert len(got) == odd.count() and (got["size"] >= 1).all()
    assert sharding.op6_query(empty).count() == 0


def test_targets_reshare_what_is_above_the_cap():
    got = mixing.targets([("a", 10), ("b", 100), ("c", 100)])
    assert got["a"] == 30 and abs(sum(got.values()) - 210) < 1e-9
    assert abs(got["b"] / got["c"] - 2) < 1e-9
    assert mixing.targets([]) == {} and mixing.targets([("a", 0)]) == {"a": 0.0}


@pytest.mark.parametrize("seed", range(6))
def test_budget_is_fitted_as_well_as_can_be(seed):
    rng = random.Random(seed)
    lengths = sorted(rng.sample(range(3, 60), 6))
    counts = [rng.randint(1, 4) for _ in lengths]
    sums = {sum(n * t for n, t in zip(lengths, take, strict=True)) for take in itertools.product(*[range(c + 1) for c in counts])}
    for budget in range(0, sum(n * c for n, c in zip(lengths, counts, strict=True)) + 1, 7):
        take = mixing.fit_budget(lengths, counts, budget)
        assert all(0 <= t <= c for t, c in zip(take, counts, strict=True))
        total = sum(n * t for n, t in zip(lengths, take, strict=True))
        assert total == max(s for s in sums if s <= budget)


def test_large_budget_is_met_exactly():
    rng = random.Random(9)
    lengths = sorted(rng.sample(range(5, 3000), 400))
    counts = [rng.randint(1, 90) for _ in lengths]
    for budget in (40_000, 1_234_567, 20_000_000):
        take = mixing.fit_budget(lengths, counts, budget)
        assert all(0 <= t <= c for t, c in zip(take, counts, strict=True))
        assert sum(n * t for n, t in zip(lengths, take, strict=True)) == budget


def test_mix_meets_targets(frame, odd, empty):
    texts = varied(900, 3)
    docs = frame([doc(i, t, source=["a", "b", None][min(i % 7, 2)]) for i, t in enumerate(texts)])
    got = mixing.op9_query(docs).toPandas().set_index("doc_id")
    again = mixing.op9_query(docs.repartition(7)).toPandas().set_index("doc_id")
    assert got["taken"].to_dict() == again["taken"].to_dict()
    sizes = {i: len(t.split()) for i, t in enumerate(texts)}
    assert got["size"].to_dict() == sizes
    source = [["a", "b", None][min(i % 7, 2)] for i in range(len(texts))]
    total = collections.Counter()
    for i, s in enumerate(source):
        total[s] += sizes[i]
    goal = mixing.targets([(s, total[s]) for s in ("a", "b", None)])
    for s in total:
        own = [i for i in range(len(texts)) if source[i] == s]
        assert abs(got.loc[own, "taken"].sum() - goal[s]) <= 1
        assert np.allclose(got.loc[own, "target"], goal[s])
    assert (got["taken"] <= 3 * got["size"]).all() and (got["taken"] % got["size"] == 0).all()
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert sum(len(r["text"].split()) for r in mixed.collect()) == got["taken"].sum()
    assert mixing.op9_query(odd).count() == odd.count() and mixing.op9_query(empty).count() == 0
    kept = mixing.mixed_documents(odd)
    assert kept.columns == odd.columns
    assert sum(len((r["text"] or "").split()) for r in kept.collect()) == mixing.op9_query(odd).toPandas()["taken"].sum()


def test_fingerprints(frame, odd, empty):
    texts = varied(300, 4, 200) + [PLAIN, PLAIN, "", None]
    ids = list(range(0, 2 * len(texts), 2))
    got = imatch.op10_query(frame([doc(i, t) for i, t in zip(ids, texts, strict=True)])).toPandas().sort_values("doc_id").reset_index(drop=True)
    assert got["doc_id"].tolist() == ids
    plain = [t or "" for t in texts]
    for i, t in enumerate(plain):
        k = len(t) // 4
        edited = t[:len(t) - k] + plain[(i + 1) % len(plain)][:k]
        assert (got["n_chars"][i], got["edited_sha256"][i]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert got["near_next"][i] == imatch.likeness(got["fingerprint"][i], got["fingerprint"][(i + 1) % len(plain)])
    assert got["fingerprint"][300] == got["fingerprint"][301] and got["near_next"][300] == 1.0
    assert got["near_edited"][:300].mean() > 0.3 > 0.1 > got["near_next"][:300].mean()
    assert imatch.op10_query(odd).count() == odd.count() and imatch.op10_query(empty).count() == 0
    assert imatch.fingerprint_documents(odd).count() == odd.count()


def test_likeness_follows_shared_terms():
    rng = random.Random(5)
    lex = np.sort(imatch.distinct_terms(*imatch.text_bytes(__import__("pyarrow").array([" ".join(f"w{i}" for i in range(400))])), None)[1])
    base = [f"w{i}" for i in rng.sample(range(200), 100)]
    texts = [" ".join(base)] + [" ".join(base[:100 - n] + [f"w{200 + i}" for i in range(n)]) for n in (5, 30, 100)]
    prints = imatch.fingerprints(*imatch.text_bytes(__import__("pyarrow").array(texts)), lex)
    near = [imatch.likeness(prints[0], p) for p in prints]
    assert near[0] == 1.0 and near[1] > near[2] > near[3]


def brute_classes(texts):
    sets = []
    for t in texts:
        w = words(t)
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else {("raw", t or "")})
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(texts)), 2):
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return [find(i) for i in range(len(texts))]


def chains(seed):
    """Texts with copies at all distances, in chains whose ends are far apart."""
    rng = random.Random(seed)
    out = []
    for t in varied(25, seed, 150):
        w = t.split()
        for _ in range(rng.randint(1, 8)):
            out.append(" ".join(w))
            w = list(w)
            for _ in range(rng.randint(0, max(1, len(w) // 60))):
                w[rng.randrange(len(w))] = f"new{rng.randrange(999)}"
    return out


def test_near_duplicates_equal_brute_force(frame):
    texts = chains(6) + TEXTS[:9]
    got = neardup.op8_query(frame([doc(i, t) for i, t in enumerate(texts)])).toPandas().set_index("doc_id")
    want = brute_classes(texts)
    assert [got.at[i, "class_id"] for i in range(len(texts))] == want
    size = collections.Counter(want)
    assert [got.at[i, "class_size"] for i in range(len(texts))] == [size[c] for c in want]


@pytest.mark.parametrize("rounds", [0, 2])
def test_large_near_group_is_one_class(frame, monkeypatch, rounds):
    """By pivots first, and by pairs within blocks alone."""
    monkeypatch.setattr(neardup, "PIVOT_ROUNDS", rounds)
    monkeypatch.setattr(neardup, "BLOCK", 40)
    rng = random.Random(7)
    base, texts = [f"v{i}" for i in range(120)], []
    for i in range(250):
        w = list(base)
        w[rng.randrange(120)] = f"x{i}"
        texts.append(" ".join(w))
    texts += [f"alone {i} " + " ".join(rng.choice(base) for _ in range(30)) for i in range(20)]
    got = neardup.op8_query(frame([doc(i, t) for i, t in enumerate(texts)])).toPandas().set_index("doc_id")
    assert [got.at[i, "class_id"] for i in range(len(texts))] == brute_classes(texts)


def test_near_duplicate_filter(odd, empty):
    kept = neardup.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    left = [r["text"] for r in kept.collect()]
    assert sum(bool(re.match("(?i)the harbour", t or "")) for t in left) == 3  # one word changed leaves 28 of 38 shingles
    assert sum(not (t or "x") or t is None for t in left) == 1
    assert neardup.drop_near_duplicates(empty).count() == 0 and neardup.op8_query(empty).count() == 0
    assert neardup.op8_query(odd).count() == odd.count()


def test_register_collisions_estimate_probability_jaccard():
    rng = np.random.default_rng(8)
    items = rng.integers(1, 1 << 60, 300).astype(np.uint64)
    a, b = {i: 1.0 + i % 3 for i in range(0, 200)}, {i: 1.0 + i % 2 for i in range(60, 260)}
    row = np.array([0] * len(a) + [1] * len(b))
    sig = neardup.signatures(row, items[[*a, *b]], np.array([*a.values(), *b.values()]), 2, 8192)
    want = sum(1 / sum(max(a.get(j, 0) / a[i], b.get(j, 0) / b[i]) for j in a.keys() | b.keys()) for i in a.keys() & b.keys())
    assert abs((sig[0] == sig[1]).mean() - want) < 0.03


def test_near_copies_that_differ_in_repeats(frame):
    """Equal or nearly equal shingle sets whose counts differ by up to a hundred times."""
    texts = []
    for i in range(30):
        head, cycle = [f"h{i}x{j}" for j in range(40)], [f"c{i}x{j}" for j in range(8 + i % 3)]
        texts += [" ".join(head + cycle * 2), " ".join(head + cycle * (100 + 6 * i))]
    got = neardup.op8_query(frame([doc(i, t) for i, t in enumerate(texts)])).toPandas().set_index("doc_id")
    assert [got.at[i, "class_id"] for i in range(len(texts))] == brute_classes(texts)


def test_bands_follow_the_threshold(frame):
    """Pairs just above a threshold of 0.6 or 0.9 are classes, pairs just below are not."""
    for similarity, kept, less in ((0.6, 81, 77), (0.9, 100, 96)):
        texts = []
        for i in range(40):
            base = [f"b{i}x{j}" for j in range(104)]
            for same in (kept, less):
                texts += [" ".join(f"{w}y{same}" for w in base), " ".join([f"{w}y{same}" for w in base[:same]] + [f"n{i}x{j}y{same}" for j in range(104 - same)])]
        got = neardup.near_duplicates(frame([doc(i, t) for i, t in enumerate(texts)]), similarity=similarity).toPandas().set_index("doc_id")
        assert [got.at[i, "class_id"] for i in range(len(texts))] == [i - 1 if i % 4 == 1 else i for i in range(len(texts))]
    assert neardup.banding(0.8) == (24, 4)


def test_links_of_a_block_are_a_spanning_set():
    import pandas as pd

    items = [np.arange(k, k + 100, dtype=np.int32) for k in range(0, 120, 2)] + [np.arange(5000, 5100, dtype=np.int32)]
    tally = [np.bincount(v % neardup.CELLS, minlength=neardup.CELLS) for v in items]
    n = len(items)
    group = pd.DataFrame({"node": np.arange(n), "label": np.arange(n), "block": 0, "low": 0, "high": 0, "tally": tally, "items": items})
    links = neardup._links_in_block(group, 0.8)
    assert len(links) == n - 2 and set(links["a"]) | set(links["b"]) == set(range(n - 1))
    assert (links["b"] - links["a"]).max() <= 5  # 90 of 110 shingles; one more step leaves 88 of 112


def test_terms_of_a_large_copied_text_count_once(frame):
    """Copies, and near copies whose terms all lie beyond the band, are still like their edits."""
    texts = varied(200, 9)
    copied = " ".join(f"copied{i}" for i in range(80))
    lex = imatch.lexicon(frame([doc(i, t) for i, t in enumerate(texts + [copied] * 200)]))
    own = imatch.distinct_terms(*imatch.text_bytes(__import__("pyarrow").array([copied])), None)[1]
    assert np.isin(own, lex).all()
    near = [" ".join(f"near{i}" for i in range(80) if i != k % 80) for k in range(160)]
    got = imatch.op10_query(frame([doc(i, t) for i, t in enumerate(texts + [f"{t} near{k % 80}" for k, t in enumerate(near)])])).toPandas().set_index("doc_id")
    assert not got["fingerprint"].str.startswith("=").any()
    assert got["near_next"][200:359].mean() > 0.5


def test_band_holds_for_small_tables(frame):
    lex = imatch.lexicon(frame([doc(i, f"common own{i}") for i in range(10)]))
    own = imatch.distinct_terms(*imatch.text_bytes(__import__("pyarrow").array(["common", "own3"])), None)
    assert {r: bool(np.isin(t, lex)) for r, t in zip(*own, strict=True)} == {0: False, 1: True}
