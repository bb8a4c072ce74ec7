"""Language models and language identification."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from trailmark.llm import language, lm

from .conftest import doc

SYLLABLES = {"en": ["th", "er", "ing", "on", "ly", "st"], "de": ["sch", "ung", "ä", "keit", "be", "ver"], "fr": ["eau", "ch", "é", "ment", "oi", "tion"]}


def made(n, seed, lang=None):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        own = lang or rng.choice(list(SYLLABLES))
        words = ["".join(rng.choice(SYLLABLES[own]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(8, 60))]
        out.append((own, " ".join(words).replace("th ", "th. ", 1) + rng.choice(["", ".", ".\n"])))
    return out


@pytest.fixture(scope="module")
def corpus(frame):
    rows = made(240, 1)
    return rows, frame([doc(i, t, lang) for i, (lang, t) in enumerate(rows)])


def held(i, modulus):
    return zlib.crc32(str(i).encode()) % modulus == 2


def test_language_is_told_on_held_out_texts(corpus):
    rows, docs = corpus
    got = language.op4_query(docs).toPandas().set_index("doc_id")
    out = [i for i in range(len(rows)) if held(i, 4)]
    assert got["held_out"].to_dict() == {i: held(i, 4) for i in range(len(rows))}
    assert np.mean([got.at[i, "lang_pred"] == rows[i][0] for i in out]) > 0.95
    assert got["score"].between(0, 1).all() and not got["rejected"].any()


def test_language_of_odd_rows(odd, empty):
    got = language.op4_query(odd).toPandas()
    assert len(got) == odd.count()
    assert set(got[got["doc_id"].isin([3, 4, 5, 6])]["lang_pred"]) == {"und"}
    assert language.op4_query(empty).count() == 0
    assert language.identify(odd, F.lit(False)).select("found.lang_pred").distinct().collect()[0][0] == "und"


def test_junk_is_rejected(corpus, frame):
    _, docs = corpus
    rng = random.Random(2)
    junk = [doc(1000 + i, " ".join("".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(9)) for _ in range(30)), None) for i in range(5)]
    got = language.identify(docs.union(frame(junk)), F.col("lang").isNotNull()).select("row.doc_id", "found.rejected").collect()
    assert {r["doc_id"] for r in got if r["rejected"]} == set(range(1000, 1005))


def test_kneser_ney_sums_to_one():
    points, at = language.letters(["abac abc", "cab"])
    spots = np.array([i for i in range(len(points)) if i not in at[:-1]])
    chars = language.tails(points, at, spots)
    counts = pd.DataFrame({"lang": "x", **{f"c{i}": c.astype(np.int64) for i, c in enumerate(chars)}, "seen": 1})
    counts = counts.groupby(["lang", "c0", "c1", "c2", "c3"], as_index=False)["seen"].sum()
    models = language.build(counts, ["x"])
    seen = sorted(set(points.tolist()))
    for before in ([97, 98, 97], [99, 97, 98], [120, 121, 122]):
        total = 0.0
        for c in seen:
            row = np.array([*before, c], np.uint32)
            which, table = models.log2p(row, np.array([0, 4]))
            total += 2 ** table[which[-1], 0]
        rest = (language.UNIVERSE - len(seen)) / language.UNIVERSE  # what the uniform part leaves to other characters
        assert 1 - rest <= total <= 1 + 1e-9


def test_texts_become_single_boundaries():
    points, at = language.letters(["Ab, 12 c!", None, "é"])
    assert points.tolist() == [0, 97, 98, 0, 99, 0, 0, 0, 233] and at.tolist() == [0, 6, 7, 9]


def plain_base(rows):
    counts = collections.Counter()
    token = re.compile(r"[^\x20\x09-\x0D]+")
    for i, (_, t) in enumerate(rows):
        if not held(i, 7):
            counts.update([*token.findall(t), None])
    n, v = sum(counts.values()), len(counts)
    out = []
    for _, t in rows:
        w = [*token.findall(t), None]
        out.append((len(w), sum(counts[x] > 0 for x in w), n, sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)))
    return out


@pytest.mark.parametrize("head", [lm.HEAD, 40])
def test_base_is_exact_and_the_model_is_better(corpus, head):
    """Also with nearly all words on the shuffled way."""
    rows, docs = corpus
    scored = lm.score_documents(docs, ~lm.held_out(F.col("doc_id"), 7), head=head)
    got = scored.withColumnRenamed("doc", "doc_id").toPandas().set_index("doc_id")
    for i, (n, known, total, base) in enumerate(plain_base(rows)):
        assert (got.at[i, "n_tokens"], got.at[i, "n_known"], got.at[i, "train_tokens"]) == (n, known, total)
        assert abs(got.at[i, "base_score"] - base) < 1e-6
    out = [i for i in range(len(rows)) if held(i, 7)]
    assert got.loc[out, "score"].sum() > got.loc[out, "base_score"].sum()
    assert (got["score"] < 0).all() and (got["bits_per_byte"] > 0).all()


def test_query_reads_capitals_as_small_letters(frame):
    """Words that differ in A-Z only are one; letters beyond A-Z keep their case."""
    texts = ["The CAT sat", "the cat SAT", "THE dog \u00c9t\u00e9 \u00e9t\u00e9", "AZ[`az{@", "Dog", "the"] * 5 + [None, ""]
    small = [re.sub("[A-Z]", lambda m: m.group().lower(), t or "") for t in texts]
    columns = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    read = lambda some: [tuple(r) for r in lm.op1_query(frame([doc(i, t) for i, t in enumerate(some)])).select(*columns).orderBy("doc_id").collect()]
    got = read(texts)
    for (i, out, *counts, base, _), (n, known, total, expected) in zip(got, plain_base(list(enumerate(small))), strict=True):
        assert (out, counts) == (held(i, 7), [n, known, total]) and abs(base - expected) < 1e-6
    assert [r[2:6] for r in read(small)] == [r[2:6] for r in got]


def test_scores_of_odd_rows(odd, empty):
    got = lm.op1_query(odd).toPandas()
    assert len(got) == odd.count() and np.isfinite(got["score"]).all()
    same = got[got["doc_id"] == 0]
    assert len(same) == 3 and same["score"].nunique() == 1
    assert lm.op1_query(empty).count() == 0


def test_words_have_hashes_of_their_own():
    texts = ["a b.\nc", "", "  x ", "\n", "a", "abba baab abba", "w" * 9000, "w" * 9001]
    raw, at = lm.text_bytes(pa.array(texts))
    row, key = lm.tokens(raw, at)
    assert row.tolist() == [0, 0, 0, 2, 4, 5, 5, 5, 6, 7]
    assert key[0] == key[4] and key[5] == key[7] and len(set(key.tolist())) == 8


def random_model(bits=14, seed=1):
    rng = np.random.default_rng(seed)
    table = lm.nodes(rng.integers(0, 5, lm.INPUTS << bits))
    mixer = lm.Mixer.fresh()
    mixer.weights = rng.uniform(0, 0.5, mixer.weights.shape)
    return table, mixer


def test_probabilities_of_all_bytes_sum_to_one():
    """One byte after a given beginning: the model is a distribution."""
    scorer = lm.Scorer(random_model()[0], 14, lm.Mixer.fresh())
    found = lm.contexts(np.frombuffer(b"the x", np.uint8))[:, -1:]
    bits = [scorer.spent(found, np.array([b], np.uint8))[0] for b in range(256)]
    assert abs(np.exp2(-np.array(bits, float)).sum() - 1) < 1e-3


def plain_bits(text, table, bits, mixer):
    """Bits of a text, one bit at a time, from the definition of the contexts."""
    wrap, k1, k2 = (1 << 64) - 1, int(lm._K), int(lm._K2)
    scrambled = lambda x: int(lm.scramble(np.array([x & wrap], np.uint64))[0])
    data = [lm.START] * lm.LEAD + list(text.encode()) + [lm.END]
    spaces = {9, 10, 11, 12, 13, 32, lm.START}
    word_hash = lambda w: sum(int(lm._LETTER[b]) * (int(lm._PLACE[i & 4095]) + (i >> 12) * k1) for i, b in enumerate(w)) & wrap
    total = 0.0
    for i in range(lm.LEAD, len(data)):
        start = i
        while data[start - 1] not in spaces:
            start -= 1
        end = start - 1
        while data[end] in spaces and data[end] != lm.START and data[end - 1] in spaces:
            end -= 1
        begin = end
        while data[end] != lm.START and data[begin - 1] not in spaces:
            begin -= 1
        so_far, prior = word_hash(data[start:i]), word_hash(data[begin:end])
        values = [sum(data[i - back] << 8 * (back - 1) for back in range(1, order + 1)) for order in lm.ORDERS]
        values += [so_far, so_far + scrambled(prior + k1) * k2]
        hashes = [(v + (j + 1) * k1) * k1 & wrap for j, v in enumerate(values)]
        hashes = [h ^ h >> 29 for h in hashes]
        for nibble in (0, 1):
            salt = 1 if nibble == 0 else ((data[i] >> 4) + 17) * k2 & wrap
            line = [((((h ^ salt) * k2 & wrap) >> (64 - (bits - 4))) << 4) + (j << bits) for j, h in enumerate(hashes)]
            known = [int(table[x]) for x in line]
            gate = ((known[lm.WORD_PAIR] * lm.CONFIDENCES + known[lm.WORD_SO_FAR]) * 3 + min(known[len(lm.ORDERS) - 1], 2)) * 2 + nibble
            node = 1
            for shift in (3, 2, 1, 0):
                bit = (data[i] >> (4 if nibble == 0 else 0) & 15) >> shift & 1
                odds = sum(int(table[x + node]) * lm.UNIT * w for x, w in zip(line, mixer.weights[gate], strict=True))
                p = mixer.refined(np.array([gate]), np.array([odds]))[0]
                total -= math.log2(p if bit else 1 - p)
                node = node << 1 | bit
    return total


def test_bits_equal_the_definition_bit_by_bit():
    table, mixer = random_model()
    texts = ["the keeper  of the\n\nlight, the", "", " é x", "\t漢字 aa"]
    got = lm.Scorer(table, 14, mixer).text_bits(pa.array(texts))
    want = [plain_bits(t, table, 14, mixer) for t in texts]
    assert np.allclose(got, want, rtol=2e-3, atol=0.02)


def test_a_context_is_looked_up_once_for_the_bits_of_a_half_byte():
    table, mixer = random_model()
    scorer = lm.Scorer(table, 14, mixer)
    at = np.arange(0, len(table), 7)
    path = scorer.paths[at].view(np.int8).reshape(-1, 4)
    for depth in range(4):
        assert (path[:, depth] == table[at - at % 16 + ((16 | at % 16) >> (4 - depth))]).all()

    class Looked:
        times, paths = 0, scorer.paths

        def take(self, spot):
            self.times += len(spot)
            return self.paths.take(spot)

    byte = np.frombuffer(b"a keeper of the light", np.uint8)
    want = scorer.spent(lm.contexts(byte), byte)
    scorer.paths = looked = Looked()
    assert (scorer.spent(lm.contexts(byte), byte) == want).all() and looked.times == 2 * lm.INPUTS * len(byte)


def test_a_step_of_learning_is_the_gradient():
    """The weights after a step, from the definition, gate by gate."""
    rng = np.random.default_rng(2)
    mixer, inputs, gate, bit = lm.Mixer.fresh(), rng.normal(0, 2, (lm.INPUTS, 50)), rng.integers(0, 3, 50), rng.integers(0, 2, 50)
    want = mixer.weights.copy()
    for g in range(3):
        error = bit[gate == g] - 1 / (1 + np.exp(-(inputs[:, gate == g].T @ want[g])))
        step = (error * inputs[:, gate == g]).mean(axis=1)
        want[g] += lm.RATE * step / np.sqrt(1e-3 + step**2)
    mixer.learn(np.full((lm.GATES, lm.INPUTS), 1e-3), inputs, gate, np.bincount(gate, minlength=lm.GATES), bit)
    assert np.allclose(mixer.weights, want)


def test_long_texts_in_pieces(monkeypatch):
    table, mixer = random_model()
    text = pa.array([" ".join(f"word{i % 97}" for i in range(900))])
    scorer = lm.Scorer(table, 14, mixer)
    whole = scorer.text_bits(text)
    monkeypatch.setattr(lm, "PIECE", 500)
    assert np.allclose(scorer.text_bits(text), whole)


def test_order_of_words_and_more_text_count(frame):
    """Texts in which every word fixes the next: shuffled words score worse, and more training text scores better."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(60)]

    def chain(at, n=60):
        return [words[(at + i) % len(words)] for i in range(n)]

    rows = [doc(i, " ".join(chain(rng.randrange(60)))) for i in range(200)]
    plain = chain(7)
    mixed = plain[:]
    rng.shuffle(mixed)
    tests = [doc(1000, " ".join(plain)), doc(1001, " ".join(mixed))]

    def score(n):
        got = lm.score_documents(frame(rows[:n] + tests), F.col("doc_id") < 1000)
        return {r["doc"]: r["score"] for r in got.collect()}

    many, few = score(200), score(20)
    assert many[1000] > 0.5 * many[1001] and many[1000] > few[1000]


def test_a_rare_label_does_not_let_junk_through(corpus, frame):
    """One mistyped label draws what no language explains, and is judged like the others."""
    rows, docs = corpus
    rng = random.Random(5)
    junk = [doc(1000 + i, " ".join("".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(9)) for _ in range(30)), None) for i in range(8)]
    rare = [doc(2000, rows[0][1] + " zq", "enn"), doc(2001, rows[1][1], "xx")]
    got = language.identify(docs.union(frame(junk + rare)), F.col("lang").isNotNull()).select("row.doc_id", "found.rejected").collect()
    assert {r["doc_id"] for r in got if r["rejected"]} == set(range(1000, 1008))


def test_rejection_limits():
    lang, ce = np.array([0] * 200 + [1] * 2), np.concatenate([np.linspace(1.9, 2.1, 200), [3.0, 3.2]])
    limits = language.rejection_limits(lang, ce, 3)
    assert abs(limits[0, 0] - 2) < 0.01 and 2 < limits[1, 0] < 2.5 and abs(limits[2, 0] - ce.mean()) < 1e-9
    assert (limits[:, 1] >= language.FLOOR).all() and (limits[:, 1] < 1).all()


def test_a_counting_task_holds_one_table(spark, monkeypatch):
    """Texts kept apart are counted by tasks of their own; both tables are those of one process."""
    finish = lm._finish

    def one_kind(group):
        assert group.groupby("part")["tune"].nunique().max() == 1
        return finish(group)

    monkeypatch.setattr(lm, "_finish", one_kind)
    texts = [(f"some words {i} and {i * i} more", i % 3 == 0) for i in range(30)]
    early, full = lm.train_tables(spark.createDataFrame(texts, "text string, tune boolean").repartition(2), 14, 2)
    expected = np.zeros((2, lm.INPUTS << 14), np.uint64)
    for text, tune in texts:
        for found, byte in lm._coded([pa.RecordBatch.from_pydict({"text": [text]})]):
            for nibble in (0, 1):
                value = (byte >> 4 if nibble == 0 else byte & 15).astype(np.int64)
                for line in lm.lines(found, byte, nibble, 14):
                    np.add.at(expected[int(tune)], line + value, np.uint64(1))
    assert (early == lm.nodes(expected[0])).all() and (full == lm.nodes(expected.sum(axis=0))).all()


def test_counts_of_tasks_and_sums_have_their_own_width():
    small, large = np.arange(lm.BLOCK, dtype=np.uint32), np.arange(lm.BLOCK, dtype=np.uint64) << np.uint64(33)
    assert (lm._counts(small.tobytes()) == small).all() and (lm._counts(large.tobytes()) == large).all()
    merged = lm._merge(pd.DataFrame({"tune": [True] * 2, "block": [3, 3], "part": [0, 1], "counts": [small.tobytes(), large.tobytes()]}))
    assert (lm._counts(merged["counts"].iloc[0]) == small + large).all()


def batch_of(texts):
    return pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})


@pytest.mark.parametrize("held", [1, 1 << 20])
def test_equal_contexts_are_counted_at_once(monkeypatch, held):
    """As many lookups for the orders as there are different bytes behind different ones, and the counts of one by one."""
    texts = ["the keeper of the light, ", "", None, " \u00e9 x\t\u6f22\u5b57", "the keeper of the light, " * 40]
    expected = np.zeros(lm.INPUTS << 14, np.uint32)
    for byte, _, own in lm.streams(pa.array(texts)):
        found = lm.contexts(byte)
        for nibble in (0, 1):
            for line in lm.lines(found, byte, nibble, 14):
                np.add.at(expected, (line + (byte >> 4 if nibble == 0 else byte & 15))[own], np.uint32(1))
    looked, order_contexts = [], lm.order_contexts
    monkeypatch.setattr(lm, "order_contexts", lambda gram, out=None: looked.extend(gram.tolist()) or order_contexts(gram, out))
    monkeypatch.setattr(lm, "GRAMS_HELD", held)
    monkeypatch.setattr(lm, "CHUNK", 30)
    assert (lm.tally(iter([batch_of(texts), batch_of(texts[:0])]), 14) == expected).all()
    assert lm.tally(iter([batch_of([])]), 14) is None
    streams = [np.frombuffer(bytes([lm.START] * lm.LEAD) + (t or "").encode() + bytes([lm.END]), np.uint8) for t in texts]
    distinct = {tuple(s[i - 5:i + 1].tolist()) for s in streams for i in range(lm.LEAD, len(s))}
    assert held == 1 or len(looked) == len(distinct)


def test_slots_that_differ_in_the_last_bit_share_an_item():
    table, mixer = random_model()
    scorer = lm.Scorer(table, 14, mixer)
    assert len(scorer.paths.pairs) == len(table) // 2
    known = table[::16].reshape(lm.INPUTS, -1)
    at = np.arange(known.shape[1])
    share = scorer.shares.reshape(lm.INPUTS, -1)
    for nibble in (0, 1):
        assert (lm.gates({i: known[i] for i in lm.GATING}, nibble) == sum(share[i, at].astype(int) for i in lm.GATING) + nibble).all()


def test_steps_of_learning_are_those_of_single_slices(monkeypatch):
    """Contexts of several steps are found together; the steps are those of one slice after the other, pieces of long texts too."""
    monkeypatch.setattr(lm, "PIECE", 700)
    texts = [*(f"text {i} of {i * i} words " * (i % 7) for i in range(60)), None, "long " * 400, "", "end"]
    want = []
    for part in lm.slices(batch_of(texts), "text", 100):
        for byte, _, own in lm.streams(part.column("text")):
            want.append((lm.contexts(byte)[:, own], byte[own]))
    for chunk in (1, 500):
        monkeypatch.setattr(lm, "CHUNK", chunk)
        got = list(lm._coded(iter([batch_of(texts)]), 100))
        assert len(got) == len(want)
        assert all((a == c).all() and (b == d).all() for (a, b), (c, d) in zip(got, want, strict=True))


@pytest.mark.parametrize("n", [0, 1, 2, 5000])
def test_finder_gives_the_sorted_place(n):
    rng = np.random.default_rng(n)
    units = np.unique(rng.integers(0, 1 << 64, n, np.uint64))
    units[:n // 10] = np.sort(units[:n // 10] >> np.uint64(40))  # many with the same first bits
    units = np.unique(units)
    key = np.concatenate([units, units + np.uint64(1), rng.integers(0, 1 << 64, 1000, np.uint64), np.array([0, (1 << 64) - 1], np.uint64)])
    assert (lm.Finder(units).find(key) == np.searchsorted(units, key)).all()
