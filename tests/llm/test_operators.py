"""The training-data operators against plain Python, with odd rows in every table."""

import base64
import hashlib
import math
import re
import zlib
from dataclasses import dataclass
from collections import Counter
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quantloom.llm import attention_lm, decontaminate, licenses, line_dedup, ngram_join, packing, quality, token_cache, toxicity, warc

BPE, PIECE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
SPACE, WORD = r"[^\x20\x09-\x0D]+", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def low(t):
    return re.sub("[A-Z]", lambda m: m.group().lower(), t or "")


def made(n=60, seed=0):
    r = np.random.default_rng(seed)
    vocabulary = ["".join(r.choice(list("abcdefghé"), r.integers(2, 8))) for _ in range(400)]
    out = []
    for i in range(n):
        words = list(r.choice(vocabulary, int(r.integers(5, 120))))
        out.append((i, "\n".join(" ".join(words[a : a + 12]) for a in range(0, len(words), 12)).capitalize() + "."))
    base = out[0][1]
    out += [(100, base), (101, base + " more"), (102, None), (103, ""), (104, " \n\t "), (105, "x"), (106, "Word " * 3000), (107, "Word " * 3000), (108, out[1][1].upper()), (109, "don't <|endoftext|> STOP. İ. éa, ...")]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", f"src{i % 3}", len(t or ""), "kept", 1.5) for i, t in made()]
    # extra columns whose names operators use themselves
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string, score double").repartition(3).cache()


@pytest.fixture
def empty(docs):
    return docs.where("false")


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_quality(docs, empty):
    got = by_id(quality.compression_bands(docs))
    for i, t in made():
        w = re.findall(SPACE, t or "")
        at = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        hit = {k + j for k in range(len(w) - 4) if at[tuple(w[k : k + 5])] > 1 for j in range(5)}
        lines = [x for x in (t or "").split("\n") if re.search(SPACE, x)]
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(lines) - len(set(lines)), len(hit))
        assert r.base_failed == (len(w) < 10 or 100 * len(hit) > 20 * len(w)) and not (r.base_failed and r.kept)
    assert got[106].verdict == "repetitive" and quality.compression_bands(empty).count() == 0


def test_bands_reject_noise(spark):
    noise = base64.b85encode(np.random.default_rng(1).bytes(6000)).decode()
    rows = spark.createDataFrame([(1, noise), (2, "the same line again\n" * 500)], "doc_id long, text string")
    assert {i: r.verdict for i, r in by_id(quality.compression_bands(rows)).items()} == {1: "incompressible", 2: "repetitive"}


def test_token_cache(docs, empty, tmp_path):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    cache = f"file://{tmp_path}/cache"
    for _ in range(2):
        got = by_id(token_cache.token_counts(docs, PIECE, cache, limit=100))
        for i, t in made():
            n = len(sp.encode(t or ""))
            assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((t or "").encode()), n, n > 100)
    known = docs.sparkSession.read.parquet(f"{cache}/*")
    assert known.count() == len({t or "" for _, t in made()})  # distinct misses, once
    assert token_cache.token_counts(empty, PIECE).count() == 0


def test_word_coder():
    """Ids by words are the library's: plain words, marks behind them, stops, special strings, other alphabets."""
    import random

    from tokenizers import Tokenizer

    r, some = random.Random(5), "abz\u00df\u00e0\u00f6\u00ff\u00f7\u00d7\u0416 !#$%&*+,./:;=?@^_~-\n.., 'sAZ\u00c97\u00b2\u00a0\u00ad<|>"
    texts = ["".join(r.choices(some, k=r.randint(0, 25))) for _ in range(5000)]
    texts += ["", "it's", "word$$$ \u00e9!! a.", "<|endoftext|> a", "a<|endoftext|>", "\u00e1 \u0345ab z\u200d!!!", " ".join(f"ab{'cd' * k}!" for k in range(4100))]
    whole = [np.array(e.ids, "<u4").tobytes() for e in Tokenizer.from_file(BPE).encode_batch_fast(texts, add_special_tokens=False)]
    assert packing.WordCoder(BPE, most=300)(texts) == whole


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(BPE)
    rows = packing.pack(docs, BPE, group_rows=16).collect()
    ids = {i: np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for i, t in made()}
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))
    bins = {}
    for r in rows:
        assert zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) == r.ids_crc32 and (r.length == 2048 or r.start + r.length == len(ids[r.doc_id]))
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n
        assert at <= 2048
    assert len(bins) <= math.ceil(sum(map(len, ids.values())) / 2048) + 1
    assert packing.pack(empty, BPE).count() == 0


def test_sum_of_squares_matches_a_plain_search():
    r = np.random.default_rng(0)
    items = r.integers(1, 20, 200)
    where, offset, fill = packing.sum_of_squares(items, 20)
    n = Counter()
    have = []
    for s, b in zip(items.tolist(), where.tolist()):
        cost = lambda g: sum(v * v for k, v in (n - Counter([g] if g < 20 else []) + Counter([g - s] if 0 < g - s else [])).items() if v > 0)  # noqa: E731, B023
        options = [g for g in range(s, 21) if g == 20 or n[g] > 0]
        g = 20 - have[b] if b < len(have) else 20
        assert cost(g) == min(map(cost, options))
        if g < 20:
            n[g] -= 1
        if g - s:
            n[g - s] += 1
        have = have + [0] if b == len(have) else have
        have[b] += s
    assert fill.sum() == items.sum()


def test_warc_round_trip(spark):
    rows = [(i, f"http://a/{i}", h) for i, h in [(3, "same"), (1, "same"), (2, "x\r\n\r\nWARC/1.1\r\n"), (4, None), (5, ""), (6, "é" * 50_000), (7, "same")]] + [(8, None, "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.response for r in warc.round_trip(pages).collect()}
    for i, _, h in rows:
        p = (h or "").encode()
        assert got[i].payload_bytes == len(p) and got[i].payload_digest == base64.b32encode(hashlib.sha1(p).digest()).decode()
    assert {i: (r.record_type, r.refers_to) for i, r in got.items() if r.record_type == "revisit"} == {3: ("revisit", 1), 7: ("revisit", 1), 5: ("revisit", 4)}
    whole = warc.round_trip(pages, least_bytes=5).where("request is not null and metadata is not null and response.record_type = 'response'")
    assert whole.count() == len(rows)
    assert warc.round_trip(pages.where("false")).count() == 0


def test_ngram_join(docs, empty, spark):
    rows = made(80, 3)
    long_text = " ".join(f"w{i}" for i in range(200))
    near = [(200 + k, long_text.replace(f"w{20 + 3 * k} ", f"z{k} ").replace(f"w{90 + 5 * k} ", f"q{k} ")) for k in range(25)] + [(300, long_text)]
    df = spark.createDataFrame(rows + near, "doc_id long, text string")
    for n, percent in ((3, 90), (5, 80)):
        sets = {}
        for i, t in rows + near:
            w = re.findall(SPACE, low(t))
            sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} or ({tuple(w)} if w else set())
        root = {i: i for i in sets}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a in sorted(sets):
            for b in sorted(sets):
                if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
        got = by_id(ngram_join.link_components(df, n, percent))
        assert {i: (got[i].n_shingles, got[i].component_id) for i in sets} == {i: (len(s), find(i)) for i, s in sets.items()}
    kept = {r.doc_id for r in ngram_join.drop_near_duplicates(docs).collect()}
    assert 0 in kept and 100 not in kept and {102, 103, 104} <= kept
    assert ngram_join.link_components(empty).count() == 0


def test_line_dedup(docs, empty, spark):
    passage = "\n".join(" ".join(f"p{k}{i}" for i in range(20)) for k in range(4))
    rows = [(i, f"own line {i} a b c\n{passage}\nlast line {i} d e f", None, None) for i in range(5)] + [(9, "short stock\nphrase", 18, "x"), (10, "short stock\nphrase", 18, "x"), (11, None, None, None), (12, "", 0, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars int, _h string")
    got = by_id(line_dedup.line_dedup(df))
    assert got[0].text == rows[0][1] and all(got[i].text == f"own line {i} a b c\nlast line {i} d e f" for i in range(1, 5))
    assert got[1].n_chars == len(got[1].text) and got[9].text == "short stock\nphrase" and got[10].text == "" and got[10].n_chars == 0 and got[11].text is None and got[12].text == ""
    assert line_dedup.line_dedup(docs).columns == docs.columns and line_dedup.line_dedup(empty).count() == 0
    copies = by_id(line_dedup.line_dedup(docs, drop_emptied=True))
    assert 0 in copies and 106 in copies and 107 not in copies


def test_decontamination(spark, empty):
    rows = made(50, 5)
    words = lambda t: re.findall(WORD, low(t))
    items = [(1, " ".join(words(rows[3][1])[2:25])), (2, " ".join(words(rows[3][1])[5:15])), (3, "Xx yy"), (4, None), (5, ""), (10, " ".join(words(rows[3][1])[5:15])), (None, "xx")]
    docs = [*rows, (500, "so XX, yy. " * 400), (501, rows[3][1]), (502, "xx"), (503, None)]
    a, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    windows = {}
    for i, t in items:
        w = words(t)
        if w and i is not None:
            n = min(10, len(w))
            for k in range(len(w) - n + 1):
                windows.setdefault(tuple(w[k : k + n]), set()).add(i)
    for block in (1 << 20, 60):
        got = by_id(decontaminate.contamination(a, b, block_bytes=block))
        for i, t in docs:
            w, hit, seen = words(t), set(), set()
            for n in {len(k) for k in windows}:
                for k in range(len(w) - n + 1):
                    if found := windows.get(tuple(w[k : k + n])):
                        hit |= set(range(k, k + n))
                        seen |= found
            names = ",".join(sorted(map(str, seen)))
            assert (got[i].n_words, got[i].n_hit, got[i].n_items, got[i].items_sha256) == (len(w), len(hit), len(seen), hashlib.sha256(names.encode()).hexdigest())
        assert {r.doc_id for r in decontaminate.decontaminate(a, b, block_bytes=block).collect()} == {i for i, r in got.items() if not r.contaminated}
    longest = [m for m in by_id(decontaminate.scan(a, b, with_matches=True))[3].matches if m.item_id == "1"]
    assert [(m.doc_at, m.length) for m in longest] == [(2, 23)]
    assert decontaminate.contamination(empty, b).count() == 0 and decontaminate.contamination(a, b.where("false")).where("contaminated").count() == 0


def test_toxicity(spark, docs, empty):
    r = np.random.default_rng(0)
    plain, bad = [f"w{chr(97 + i)}{chr(97 + j)}rd" for i in range(12) for j in range(12)], ["moron", "idiot", "stupid"]
    rows, labels = [], []
    for i in range(600):
        words, toxic = list(r.choice(plain, 40)), i % 5 == 0
        if toxic:
            words[7], words[20] = r.choice(bad, 2)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    rows += [(1000, " ".join(plain[:30]) + " m0r0n and 1diot"), (1001, " ".join(plain[:30]) + " s t u p i d stuuupid"), (1002, None), (1003, "")]
    a, b = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = by_id(toxicity.toxicity(a, b))
    held = [i for i, _ in labels if got[i].held_out]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in got)
    assert np.mean([got[i].predicted == dict(labels)[i] for i in held]) > 0.95
    assert got[1000].predicted == got[1001].predicted == 1 and got[1002].predicted == got[1003].predicted == 0
    assert {x.doc_id for x in toxicity.drop_toxic(a, b).collect()} == {i for i, x in got.items() if not x.predicted}
    assert toxicity.toxicity(empty, b).count() == 0
    assert max(x.score for x in toxicity.toxicity(docs, b.where("false")).collect()) < 1e-9


def test_disguises_are_read():
    counts = toxicity.trigrams([" idiot hell kill ass die stupid word of the text and what it says " * 50])
    restore = toxicity.Restore.of(counts)
    disguised = {"idi07": "idiot", "he11": "hell", "ki11": "kill", "a55": "ass", "a$$": "ass", "a s s": "ass", "d i e": "die", "stu-pid": "stupid", "id.iot": "idiot", "stuupid": "stupid", "idiott": "idiot"}
    for span, word in disguised.items():
        assert word in toxicity.WORD.findall(restore.text(f"So, {span}, that says", {})), span
    assert restore.text("the text of 2024-05-01, 1.2.3 and what it says.", {}) == "the text of 2024-05-01, 1.2.3 and what it says."


def test_a_generic_reference_hides_no_licence(spark):
    named = {
        "licensed under the eclipse public license": ("epl", 0.7),
        "Released under the Mozilla Public License": ("mpl", 0.7),
        "distributed under the bsd license": ("bsd", 0.7),
        "licensed under the gnu lesser general public license": ("lgpl", 0.7),
        "distributed under the boost software license": ("bsl-1.0", 0.7),
        "licensed under the creative commons attribution 4.0 license": ("cc-by", 0.9),
        "licensed under the open government license": ("open-government", 0.4),
        "SPDX-License-Identifier: Apache-2.0.": ("apache-2.0", 1.0),
        "SPDX-License-Identifier: BSD-2-Clause-Patent": ("spdx-other", 1.0),
        "licensed under the frobnitz license": ("license-reference", 0.4),
    }
    got = by_id(licenses.license_scan(spark.createDataFrame(list(enumerate(named)), "doc_id long, text string")))
    for i, (label, score) in enumerate(named.values()):
        assert any(x.startswith(label) for x in got[i].labels.split(",")) and got[i].score >= score, (got[i], label)
    assert got[8].labels == "spdx-other" and got[9].labels == "license-reference"


def test_licenses(spark, docs, empty):
    rows = [(1, "Released under the MIT License. See MIT  license; mit-license"), (2, "the GNU General Public License, version 3 applies"), (3, "SPDX-License-Identifier: Apache-2.0"), (4, None), (5, "permit licensed"), (6, "MIT License\n" * 3000), (7, "CC BY-NC-SA 4.0 text")]
    got = by_id(licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string")))
    for i, t in rows:
        w = re.findall(WORD, low(t))
        at = sorted(k for p in licenses.PHRASES for k in range(len(w)) if w[k : k + len(p.split())] == p.split())
        assert (got[i].n_words, got[i].n_base, got[i].first_word, got[i].last_word) == (len(w), len(at), at[0] if at else None, at[-1] if at else None)
        assert set(got[i].base_labels.split(",")) <= set(got[i].labels.split(",")) | {""} and 0 <= got[i].score <= 1
    # the longer detection suppresses the shorter within it
    assert got[2].labels == "gpl,gpl-3.0" and got[3].labels == "apache-2.0" and got[7].labels == "cc-by-nc-sa" and got[4].labels == ""
    assert licenses.license_scan(docs).count() == docs.count() and licenses.license_scan(empty).count() == 0


def test_attention_scores(docs, empty):
    got = by_id(attention_lm.attention_scores(docs, BPE, frequent=50))
    c = Counter()
    for i, t in made():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            c.update(re.findall(SPACE, low(t)))
            c[None] += 1
    total, distinct = sum(c.values()), len(c)
    for i, t in made():
        w = [*re.findall(SPACE, low(t)), None]
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(c[x] > 0 for x in w), total)
        assert r.base_score == pytest.approx(sum(math.log10((c[x] + 1) / (total + distinct + 1)) for x in w)) and r.score < 0
    assert attention_lm.attention_scores(empty, BPE).count() == 0


def test_attention_scores_do_not_depend_on_partitions(docs, spark):
    """Shards of two windows; how rows are cut into tasks changes neither the shards nor their order."""
    scores = lambda n: {r.doc_id: r.score for r in attention_lm.attention_scores(docs.repartition(n), BPE, width=8, overlap=2, shard=2).collect()}
    two, nine = scores(2), scores(9)
    assert two.keys() == nine.keys() and all(two[i] == pytest.approx(nine[i], rel=1e-5) for i in two)


def test_attention_shards():
    """Each shard learns from its own windows, whatever batches they come in; long ones by parts of `most`."""
    seen = []

    @dataclass
    class Plain:
        width: int = 4
        weights: dict | None = None

        def trained(self, windows):
            seen.append(sorted(map(tuple, windows.tolist())))
            return {"w": np.full(2, len(windows), float)}

        def packed(self):
            return self.weights["w"]

    rng = np.random.default_rng(3)
    rows = [(k, rng.integers(1, 99, rng.integers(2, 30)).astype("<u2")) for k in (0, 0, 0, 2, 2, 7)]
    runs = []
    for cuts in ([6], [1, 2, 3], [2, 2, 2]):
        seen.clear()
        at = np.cumsum([0, *cuts])
        batches = [pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows[i:j]], pa.int32()), pa.array([x.tobytes() for _, x in rows[i:j]], pa.binary())], names=["shard", "ids"]) for i, j in zip(at, at[1:], strict=False)]
        (got,) = attention_lm.TrainShard(SimpleNamespace(value=Plain()), most=5)(iter(batches))
        runs.append((list(map(tuple, seen)), got.to_pydict()))
    sizes = [sum(-(-(len(x) - 1) // 4) for k, x in rows if k == shard) for shard in (0, 2, 7)]
    parts = [p for n in sizes for p in [5] * (n // 5) + [n % 5] * (n % 5 > 0)]
    assert [len(p) for p in runs[0][0]] == parts and all(r == runs[0] for r in runs)
    assert runs[0][1]["x"] == [sum(p * p for p in parts)] * 2 and runs[0][1]["n"] == [sum(parts)] * 2


def pieces(texts):
    return [[attention_lm.END, *x, attention_lm.END] for x in attention_lm.ids_of(packing.WordCoder(BPE), [t or "" for t in texts])]


def sequences(seqs):
    return pa.RecordBatch.from_arrays([pa.array([np.array(x, "<u2").tobytes() for x in seqs])], names=["ids"])


def test_attention_learns_from_whole_texts():
    texts = ["the cat sat on a mat " * 400 + "zebra", "so", "", None]
    cols = [pa.array(range(4)), pa.array(range(4)), pa.array([False] * 4), pa.array(texts, pa.string())]
    (b,) = attention_lm.Encode(BPE, SimpleNamespace(value={b"": 0.0}))(iter([pa.RecordBatch.from_arrays(cols, names=["_row", "doc_id", "held", "text"])]))
    want = pieces(texts)
    ids, n = attention_lm.joined(b, 7)
    assert ids.tolist() == [x for w in want for x in w] and n.tolist() == list(map(len, want)) and n[0] > 2400
    # every id and the end is a target once, after the ids before it
    windows = attention_lm.window_table(ids, n, 48)
    assert windows[:, 1:][windows[:, 1:] >= 0].tolist() == [x for w in want for x in w[1:]]
    (c,) = attention_lm.CountIds()(iter([sequences(want)]))
    assert dict(zip(c.column(0).to_pylist(), c.column(1).to_pylist(), strict=True)) == Counter(x for w in want for x in w[1:])
    m = attention_lm.Model.fresh(np.bincount(ids, minlength=attention_lm.VOCABULARY).astype(float), np.ones(attention_lm.VOCABULARY, np.int64), 48, 3)
    (c,) = attention_lm.CountPairs(SimpleNamespace(value=m.unit_of))(iter([sequences(want)]))
    pairs = Counter(m.unit_of[x] * attention_lm.UNITS + m.unit_of[y] for w in want for x, y in zip(w, w[1:], strict=False))
    assert dict(zip(c.column(0).to_pylist(), c.column(1).to_pylist(), strict=True)) == pairs


def trained_model(seqs, width=12, rounds=3):
    ids, n = np.concatenate(seqs), np.array(list(map(len, seqs)))
    counts = np.bincount(ids, minlength=attention_lm.VOCABULARY).astype(float)
    m = attention_lm.Model.fresh(counts, np.zeros(attention_lm.VOCABULARY, np.int64), width, 3)
    u = m.unit_of[ids]
    pairs = np.bincount(np.delete(u[:-1] * attention_lm.UNITS + u[1:], np.cumsum(n)[:-1] - 1), minlength=attention_lm.UNITS**2).reshape(attention_lm.UNITS, -1)
    m = m.counted(counts, pairs.astype(float))
    for _ in range(rounds):
        m.weights = m.trained(attention_lm.window_table(ids, n, width))
    return m


def test_attention_score_is_that_of_a_plain_loop():
    seqs = [np.array(x) for x in pieces(["the cat sat on a mat and the dog on the log " * 9, "a dog", "", "zebra of the cat"])]
    m, overlap = trained_model(seqs), 4
    m.weights["q"] *= 40  # heads far beyond what an unshifted exponential could take
    got = attention_lm.Score(SimpleNamespace(value=m), overlap).scores(m, np.concatenate(seqs), np.array(list(map(len, seqs))))
    w = {k: v.astype(float) for k, v in m.weights.items()}
    soft = lambda s: np.exp(s - s.max()) / np.exp(s - s.max()).sum()
    for seq, score in zip(seqs, got, strict=True):
        total = 0.0
        for t in range(1, len(seq)):
            # the window in which place t is new: the first, or that which begins `width - overlap` ids further each time
            k = max(0, -(-(t - m.width) // (m.width - overlap)))
            e = w["e"][m.unit_of[seq[k * (m.width - overlap) : t]]]
            q, keys = e[-1] @ w["q"], e @ w["k"]
            a = soft(np.array([q @ x + w["r"][len(keys) - 1 - j] for j, x in enumerate(keys)]))
            prev, u = m.unit_of[seq[t - 1]], m.unit_of[seq[t]]
            p = soft((a @ (e @ w["v"])) @ w["o"] + m.bigram[prev])[m.class_of[u]]
            total += np.log10(p) + (m.within[prev, u] + m.in_unit[seq[t]]) / np.log(10)
        assert score == pytest.approx(total, rel=1e-3)


ODD = [None, "", " \n\t ", "x", "a\tb\x0bc\x0cd\re  f\x1cg\x85h\u3000i j", "<|EndOfText|> Foo <|endoftext|>bar", "A<|B C", "İ É x\u0301 \u0301y", ".a..b . . 'S don't STOP.", " lead", "trail ", "Word " * 300, "1 2 33 4.5.6 a.B.c"]


def test_attention_words_meet_the_tokenizer_once(monkeypatch):
    """Ids are those of whole texts, also when the table of words is full; a later task of a worker encodes no word again."""
    attention_lm.worker_store("none", "none")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BPE)
    want = [[attention_lm.END, *tokenizer.encode(t or "", add_special_tokens=False).ids, attention_lm.END] for t in ODD]
    b = pa.RecordBatch.from_arrays([pa.array(range(len(ODD))), pa.array(range(len(ODD))), pa.array([False] * len(ODD)), pa.array(ODD, pa.string())], names=["_row", "doc_id", "held", "text"])
    met = []
    encode = packing.WordCoder.encode
    monkeypatch.setattr(packing.WordCoder, "encode", lambda self, words: met.extend(words) or encode(self, words))
    known = SimpleNamespace(value={b"": 1.0, b"word": 0.5, b"a": 0.25})
    for most, parts in ((1000, 1), (1000, 13), (9, 13)):
        met.clear()
        got = [r for i in range(parts) for x in attention_lm.Encode(BPE, known, most)(iter([b.slice(i, 1) if parts > 1 else b])) for r in x.to_pylist()]
        assert [np.frombuffer(r["ids"], "<u2").tolist() for r in got] == want
        for t, r in zip(ODD, got, strict=True):
            words = [w.encode() for w in re.findall(SPACE, low(t))]
            assert (r["n_tokens"], r["rare"]) == (len(words) + 1, [w for w in words if w not in known.value])
            assert r["known"] == len(words) + 1 - len(r["rare"]) and r["logs"] == pytest.approx(1 + sum(known.value.get(w, 0) for w in words))
        if parts > 1 and most == 1000:
            assert not set(met) & {w for t in ODD if "<|" not in (t or "") for w in re.findall(SPACE, low(t))}


def test_attention_counts_words_in_parts():
    got, texts = Counter(), ODD * 3
    batches = [pa.RecordBatch.from_arrays([pa.array([t], pa.string())], names=["text"]) for t in texts]
    sent = list(attention_lm.CountWords(most=4)(iter(batches)))
    for b in sent:
        for r in b.to_pylist():
            got[r["kind"], r["token"]] += r["n"]
    assert len(sent) > 3 and got == Counter(("word", w.encode()) for t in texts for w in re.findall(SPACE, low(t))) + Counter({("texts", b""): len(texts)})


def test_attention_step_in_used_arrays():
    """Slopes don't depend on what arrays held before nor on how many windows go at a time, also beyond plain exponentials."""
    r = np.random.default_rng(5)
    m = attention_lm.Model.fresh(np.ones(attention_lm.VOCABULARY), np.zeros(attention_lm.VOCABULARY, np.int64), 12, 3)
    m.weights["o"] = r.normal(0, 0.3, m.weights["o"].shape).astype(np.float32)
    x, y = r.integers(0, attention_lm.UNITS, (7, 12)), r.integers(0, attention_lm.CLASSES, (7, 12))
    room = attention_lm.Room()
    for scale in (1, 200):
        m.weights["q"] *= scale
        plain = m.gradients(x, y, np.ones(x.shape, bool))
        m.gradients(r.integers(0, attention_lm.UNITS, (20, 12)), r.integers(0, attention_lm.CLASSES, (20, 12)), np.ones((20, 12), bool), room)
        for some in (1, 3, 7):
            again = m.gradients(x, y, np.ones(x.shape, bool), room, some)
            assert all(np.isfinite(again[n]).all() and np.allclose(again[n], plain[n], atol=1e-6, rtol=1e-3) for n in plain)
        old, loss = m.weights["o"][3, 5], lambda: -m.ready().log_class(x, y).mean()
        m.weights["o"][3, 5] = old + 0.05
        up = loss()
        m.weights["o"][3, 5] = old - 0.05
        assert (up - loss()) / 0.1 == pytest.approx(plain["o"][3, 5], rel=0.05, abs=1e-4)
        m.weights["o"][3, 5] = old


def test_attention_beats_counts_of_words_and_of_pairs():
    """Held-out texts of a language in which the word before last matters: pairs can't see it, attention can."""
    r = np.random.default_rng(4)
    words = ["cat", "dog", "sun", "moon", "tree", "stone"]

    def text():
        out = [0, 1]
        while len(out) < 60:
            out.append((out[-2] + 1) % 6 if r.random() < 0.9 else int(r.integers(6)))
        return " ".join(words[k] for k in out)

    seqs = [np.array(x) for x in pieces([text() for _ in range(400)])]
    held = [np.array(x) for x in pieces([text() for _ in range(50)])]
    m = trained_model(seqs, 24, 2)
    score = lambda m: attention_lm.Score(None, 8).scores(m, np.concatenate(held), np.array(list(map(len, held)))).sum()
    plain = attention_lm.replace(m, weights=m.weights | {"o": 0 * m.weights["o"]})
    counts = Counter(x for s in seqs for x in s[1:])
    base = sum(math.log10((counts[x] + 1) / (sum(counts.values()) + len(counts) + 1)) for s in held for x in s[1:])
    assert score(m) > 0.9 * score(plain) and score(m) > 0.9 * base


def test_attention_model_has_its_full_size(monkeypatch):
    counts = np.arange(attention_lm.VOCABULARY, 0, -1).astype(float)
    m = attention_lm.Model.fresh(counts, np.arange(attention_lm.VOCABULARY) % 2, 12, 3)
    assert len(set(m.class_of[m.unit_of])) == 64 and (np.bincount(m.class_of[m.unit_of])[:48] == 1).all()
    assert (np.bincount(m.unit_of)[:2016] == 1).all() and m.unit_of.max() < 2048
    steps = []
    monkeypatch.setattr(attention_lm.Model, "gradients", lambda self, x, *_: steps.append(len(x)) or {})
    m.trained(np.ones((192, 13), np.int64))
    assert steps == [64, 64, 64]


def test_attention_sums_to_one_and_gradients_are_right():
    r = np.random.default_rng(0)
    m = attention_lm.Model.fresh(r.integers(0, 9, attention_lm.VOCABULARY).astype(float), r.integers(0, 2, attention_lm.VOCABULARY), 12, 3)
    m.weights["o"] = r.normal(0, 0.3, m.weights["o"].shape).astype(np.float32)
    x = r.integers(0, attention_lm.UNITS, (2, 12))
    ready = m.ready()
    p = sum(np.exp(ready.log_class(x, np.full(x.shape, c))) for c in range(attention_lm.CLASSES))
    assert np.allclose(p, 1, atol=1e-4)
    assert np.isclose(np.exp(m.in_unit).sum(), len(set(m.unit_of)))
    pairs = np.zeros((attention_lm.UNITS, attention_lm.UNITS))
    pairs[5, :90] = r.integers(0, 4, 90)
    m = m.counted(np.ones(attention_lm.VOCABULARY), pairs)
    for prev in (5, 6):
        of = np.bincount(m.class_of, np.exp(m.within[prev]), attention_lm.CLASSES)
        assert np.allclose(of[of > 0], 1, atol=1e-3) and np.isclose(np.exp(m.bigram[prev]).sum(), 1, atol=1e-4)
    ready = m.ready()
    y = r.integers(0, attention_lm.CLASSES, x.shape)
    loss = lambda: -m.ready().log_class(x, y).mean()
    g = m.gradients(x, y, np.ones(x.shape, bool))
    for n in ("q", "k", "v", "o", "r"):
        flat, at = m.weights[n].reshape(-1), int(np.argmax(np.abs(g[n])))
        old = flat[at]
        flat[at] = old + 0.01
        up = loss()
        flat[at] = old - 0.01
        slope = (up - loss()) / 0.02
        flat[at] = old
        assert slope == pytest.approx(g[n].reshape(-1)[at], rel=0.05, abs=1e-4), n
    # what comes later can't change an earlier score
    z = x.copy()
    z[:, 8:] = 1
    assert np.allclose(ready.log_class(x, y)[:, :8], ready.log_class(z, y)[:, :8])
    # context that isn't scored, and blocks of queries, leave the other scores as they are
    assert np.allclose(ready.log_class(x, y, 3, 4), ready.log_class(x, y, 0, 12)[:, 3:], atol=1e-5)


def test_pipeline_keeps_columns(spark, tmp_path):
    import corpus_pipeline

    rows = [(i, t, "en", "s", len(t or "")) for i, t in made(40, 9)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 0)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    item = " ".join(re.findall(WORD, low(rows[5][1]))[:14])
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
    packed = corpus_pipeline.run(spark, str(tmp_path))
    left = {r.doc_id for r in packed.select("doc_id").distinct().collect()}
    assert 5 not in left and 100 not in left and {0, 1, 2, 102} <= left
    assert packed.where(F.col("offset") + F.col("length") > 2048).count() == 0
