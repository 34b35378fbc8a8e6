"""Spelling variants, vector codes and quality from positives, against plain Python and on odd tables."""

import hashlib
import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quantloom.llm import quality_pu, spelling, vector_codes

SCHEMA = "doc_id long, text string, word string, prefix string, n int, id int, size int, run string"
EXTRA = ("w", "p", 1, 2, 3, "r")


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b or min(len(a), len(b)) > 100 and a[:-1] != b[: len(a) - 1] and b[:-1] != a[: len(b) - 1]:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def spelling_spec(rows):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}
    found = {w: [] for w in n}
    for a, b in itertools.combinations(n, 2):
        if near(a, b):
            found[a].append(b)
            found[b].append(a)
    form = {}
    for w, others in found.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (n[w], len(found[w]), form[w], n[form[w]] if form[w] else None, root)
    return out


def words_of(seed):
    r = np.random.default_rng(seed)
    base = ["".join(r.choice(list("abé"), int(r.integers(7, 10)))) for _ in range(25)]
    out = []
    for w in base:
        out += [w] * int(r.integers(1, 60))
        for _ in range(int(r.integers(0, 9))):
            i, c = int(r.integers(0, len(w))), str(r.choice(list("abcé")))
            other = [w[:i] + c + w[i:], w[:i] + w[i + 1 :], w[:i] + c + w[i + 1 :]][int(r.integers(0, 3))]
            out += [other] * int(r.integers(1, 5))
    r.shuffle(out)
    return out


@pytest.mark.parametrize(("seed", "hot"), [(0, 1000), (1, 1), (2, 5)])
def test_spelling_matches_brute_force(spark, seed, hot):
    w = words_of(seed)
    rows = [(i, " ".join(w[a : a + 20])) for i, a in enumerate(range(0, len(w), 20))]
    rows += [(900, None), (901, ""), (None, "Straßenbahn ABCDÉFGH abcdÉfgh abcdéfgh " * 3), (902, f"{'xy' * 9_000}a {'xy' * 9_000} {'xy' * 9_000}b {'x' * 64} {'x' * 65} {'x' * 66}"), (902, f"{'xy' * 9_000}a {'xy' * 9_000} {'xy' * 9_000}b {'x' * 64} {'x' * 65} {'x' * 66}"), (1, "aaaaaaaa aaaaaaaaa aaaaaaaaaa " * 40)]
    df = spark.createDataFrame([(*x, *EXTRA) for x in rows], SCHEMA).repartition(3)
    got = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in spelling.spelling_variants(df, hot=hot).collect()}
    assert got == spelling_spec(rows)
    assert any(r[4] != k for k, r in got.items())


def test_each_pair_once_and_moves_are_few(spark):
    r = np.random.default_rng(3)
    words = sorted({"".join(r.choice(list("abc"), int(r.integers(7, 10)))) for _ in range(500)})
    df = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    got = [(p.a, p.b) for p in spelling.one_edit_pairs(df, hot=3).collect()]
    assert sorted(got) == sorted(tuple(sorted(p)) for p in itertools.combinations(words, 2) if near(*p))
    # small to large: no word is moved more often than the logarithm of their number
    most = spelling.light_edges(df, hot=3).groupBy("word").count().agg(F.max("count")).first()[0]
    assert most <= np.log2(len(words))


def test_a_word_of_megabytes(spark):
    """Alone it costs a lookup; beside a near one its nodes are rows of a fixed size."""
    r = np.random.default_rng(0)
    word = "".join(r.choice(list("abcdefgh"), 1_000_000))
    words = spark.createDataFrame([(word, 50), (word[:500_000] + word[500_001:], 2), ("".join(r.choice(list("xyz"), 3_000_000)), 3)], "word string, n long")
    got = {len(x.word): (x.n_near, -x.best.m) for x in spelling.near_words(words).collect()}
    assert got == {1_000_000: (1, 2), 999_999: (1, 50)}


def test_forms_lead_to_their_root_over_many_steps(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(18)]
    got = {r.word: r.root for r in spelling.roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert got == {a: "w18" for a, _ in chain}


def codes_spec(rows, parts=4, entries=256, rounds=4):
    kept = [(i, [int(np.floor(1024 * x)) for x in v], c) for i, v, c in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    d = len(kept[0][1]) // parts
    cut = lambda v: [tuple(v[p * d : p * d + d]) for p in range(parts)]
    books = [[cut(v)[p] for _, v, _ in kept[:entries]] for p in range(parts)]
    for r in range(rounds + 1):
        codes = [[min((sum((a - b) ** 2 for a, b in zip(y, e, strict=True)), j) for j, e in enumerate(books[p])) for p, y in enumerate(cut(v))] for _, v, _ in kept]
        if r < rounds:
            for p in range(parts):
                mine = {}
                for (_, v, _), c in zip(kept, codes, strict=True):
                    mine.setdefault(c[p][1], []).append(cut(v)[p])
                for j, ys in mine.items():
                    books[p][j] = tuple(sum(c) // len(ys) for c in zip(*ys, strict=True))
    total = Counter()
    for (_, _, label), c in zip(kept, codes, strict=True):
        total[label] += sum(e for e, _ in c)
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return Counter((i, "".join(f"{j:02x}" for _, j in c), sum(e for e, _ in c), total[label], digest) for (i, _, label), c in zip(kept, codes, strict=True))


@pytest.mark.parametrize(("n", "scale", "groups"), [(420, 0.3, 16), (420, 0.004, 3), (40, 1.0, 16), (300, 90_000.0, 8)])
def test_codes_match_brute_force(spark, n, scale, groups):
    """Small scales make many exact ties, large ones leave the range of exact floats."""
    r = np.random.default_rng(n)
    centres = r.normal(0, scale, (6, 8))
    rows = [(int(i), [float(np.float32(x)) for x in centres[i % 6] + r.normal(0, scale / 4, 8)], None if i % 5 == 0 else int(i % 3)) for i in r.permutation(n)]
    rows += [(3, rows[0][1], 1), (3, rows[0][1], 1), (None, rows[1][1], 2), (n + 1, None, 1), (n + 2, [1.0] * 7 + [None], 1), (n + 3, [float("nan")] * 8, 1), (n + 4, [float("inf")] + [0.0] * 7, 0)]
    df = spark.createDataFrame([(*x, 7, "c") for x in rows], "vec_id long, embedding array<float>, label int, id int, code string").repartition(5)
    got = Counter(tuple(x) for x in vector_codes.vector_codes(df, groups=groups).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect())
    assert got == codes_spec(rows)


def test_bounds_spare_scans(spark):
    """After the first round most groups of a clustered table aren't scanned, and results stay exact."""
    r = np.random.default_rng(1)
    x = np.floor(1024 * (r.normal(0, 1, (16, 8))[r.integers(0, 16, 3000)] + r.normal(0, 0.02, (3000, 8)))).astype(np.int64)
    of = vector_codes.grouped(x[:64], 16)
    book = vector_codes.Book(x[:64], of, np.zeros(of.max() + 1))
    code, _, bounds = book.assign(x, None, None)
    for _ in range(3):
        sums = {int(j): (int((code == j).sum()), x[code == j].sum(0).tolist()) for j in np.unique(code)}
        book = book.updated(sums)
        own = np.sqrt(((x - book.entries[code]) ** 2).sum(1).astype(float))
        scanned = (bounds - book.moved <= own[:, None]).mean()
        code, error, bounds = book.assign(x, code, bounds)
        full = ((x[:, None] - book.entries) ** 2).sum(2)
        assert (code == full.argmin(1)).all() and (error == full.min(1)).all()
        # a kept bound is one
        full[np.arange(len(x)), code] = np.iinfo(np.int64).max
        for g in range(book.groups):
            low = np.clip(bounds[:, g].astype(float), 0, 2e9)
            assert (low**2 <= full[:, book.group == g].min(1)).all()
    assert scanned < 0.5


def test_odd_vectors(spark):
    schema = "vec_id long, embedding array<float>, label string"
    none = vector_codes.vector_codes(spark.createDataFrame([], schema))
    assert none.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and none.count() == 0
    rows = [(1, [0.5, 0.25, 1.0, 2.0], "a"), (2, [0.5] * 8, "a"), (3, [], "a"), (4, [1e30] * 4, "b"), (5, [0.5] * 3, "b")]
    got = {r.vec_id: r for r in vector_codes.vector_codes(spark.createDataFrame(rows, schema)).collect()}
    assert got[1].code == "00000000" and got[1].error == 0 and got[1].label_error == 0
    assert all(got[i].code is None and got[i].error is None for i in (2, 3, 4, 5)) and got[2].label_error == 0 and got[4].label_error is None


def texts(n, seed=0):
    """Prose, of which a fifth is junk of three kinds; labels for half."""
    r = np.random.default_rng(seed)
    vocabulary = ["".join(r.choice(list("aeinorst"), int(r.integers(2, 9)))) for _ in range(500)]
    docs, labels = [], []
    for i in range(n):
        words = list(r.choice(vocabulary, int(r.integers(30, 150))))
        good = r.random() > 0.2
        if not good:
            kind = i % 3
            words = [w + "$$$" for w in words] if kind == 0 else [w.upper() + "!!" for w in words] if kind == 1 else words[:3] * 30
        t = "\n".join(" ".join(words[a : a + 12]).capitalize() + "." * good for a in range(0, len(words), 12))
        docs.append((i, t))
        if r.random() < 0.5:
            labels.append((i, int(good)))
    return docs, labels


def test_quality_from_positives_on_held_out_rows(spark):
    docs, labels = texts(700)
    truth = dict(labels)
    odd = [(None, docs[0][1]), (5, docs[5][1]), (5, docs[5][1]), (8000, None), (8001, ""), (8002, "word " * 400_000)]
    df = spark.createDataFrame([(*x, "en", 0.5, 1) for x in docs + odd], "doc_id long, text string, stats string, score double, trusted int").repartition(3)
    known = spark.createDataFrame([(*x, 0) for x in [*labels, (None, 1), (7, None), (5, 1)]], "doc_id long, quality int, toxic int")
    rows = quality_pu.quality(df, known).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in docs + odd)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert len({r.score for r in rows if r.doc_id == 5}) == 1
    tried = [r for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in tried]) > 0.95
    # a label that the fold may not read changes nothing
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q) for i, q in labels]
    again = quality_pu.quality(df, spark.createDataFrame(flipped, "doc_id long, quality int")).collect()
    assert {(r.doc_id, round(r.score, 9)) for r in again if r.doc_id != 5} == {(r.doc_id, round(r.score, 9)) for r in rows if r.doc_id != 5}


def test_quality_without_labels_or_rows(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in quality_pu.quality(df, none).collect()] == [0.5, 0.5]
    assert [r.score for r in quality_pu.quality(df, spark.createDataFrame([(1, 0)], none.schema)).collect()] == [0.5, 0.5]
    out = quality_pu.quality(df.where("false"), none)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"] and out.count() == 0


def test_statistics_in_plain_python():
    t = "One two, two.\n### A b c\n\nOne two, two.\none TWO three four five one TWO three four five"
    got = dict(zip(quality_pu.STATS, quality_pu.statistics(t), strict=True))
    words = t.split()
    chars = sum(map(len, words))
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    assert got["words_log"] == pytest.approx(np.log1p(len(words))) and got["symbols"] == 3 / chars
    assert got["capitals"] == sum("A" <= c <= "Z" for c in t) / chars and got["marks"] == sum(c in ",." for c in t) / chars
    assert got["repeated_windows"] == pytest.approx(1 - len(set(windows)) / len(windows))
    assert got["distinct_words"] == len(set(words)) / len(words) and got["repeated_lines"] == 0.25 and got["lines_ended"] == 0.5
    assert len(quality_pu.statistics("")) == len(quality_pu.STATS)


def test_the_risk_is_the_unbiased_one_and_minimal(spark):
    """The risk's gradient, computed plainly, vanishes at the weights; the negatives' term stays at 0 or above."""
    r = np.random.default_rng(5)
    k = len(quality_pu.STATS)
    good = r.random(600) < 0.7
    stats = r.normal(0, 1, (600, k)) + np.where(good, 0.7, -0.7)[:, None] * (np.arange(k) < 3)
    trusted = (good & (r.random(600) < 0.4)).astype(float)
    df = spark.createDataFrame([(s.tolist(), float(t)) for s, t in zip(stats, trusted, strict=True)], "stats array<double>, trusted double")
    model = quality_pu.Model(np.zeros(k), np.ones(k), np.zeros(1 + 2 * k))
    n, m, prior = 600.0, trusted.sum(), 0.7
    got = quality_pu.learn(df, model, n, m, prior, ridge=0.05)
    x = model.inputs(stats)
    keep = np.diag([5e-8, *[0.05 + 1 / m] * (2 * k)])
    slope = (1 / (1 + np.exp(-x @ got))) @ x / n - prior * trusted @ x / m + keep @ got
    z = x @ got
    negatives = np.logaddexp(0, z).mean() - prior * (trusted @ np.logaddexp(0, z)) / m
    assert negatives >= 0 and np.abs(slope).max() < 1e-4
    assert abs(quality_pu.class_prior(df, quality_pu.Model(model.mean, model.scale, got), n, m) - 0.7) < 0.15
