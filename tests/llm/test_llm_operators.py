"""Every operator over one messy corpus, against plain Python over the same rows."""

from __future__ import annotations

import collections
import hashlib
import math
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from corpus import COLUMNS, frame, lower_words, messy_rows, order, words  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from shoptrail.llm import bpe, chunk_dedup, decontaminate, html_blocks, ngram_join, ngram_lm  # noqa: E402
from shoptrail.llm import queries as text_queries  # noqa: E402
from shoptrail.llm import risk_rules, simple8b, suffix_dedup, toxicity  # noqa: E402
from shoptrail.llm.components import components  # noqa: E402

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def rows():
    return messy_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], COLUMNS)


def bag(items):
    return collections.Counter(items)


# --- substrings -----------------------------------------------------------------------------------


def covered(rows):
    """Per row (id, bytes, flags) by looking up every 50-byte string."""
    first = {}
    for r in rows:
        b = (r[1] or "").encode()
        for k in range(len(b) - 49):
            first[b[k : k + 50]] = min(first.get(b[k : k + 50], math.inf), order(r[0]))
    for r in rows:
        b = (r[1] or "").encode()
        flags = bytearray(len(b))
        for k in range(len(b) - 49):
            if first[b[k : k + 50]] < order(r[0]):
                flags[k : k + 50] = b"\1" * 50
        yield r, b, flags


@pytest.mark.parametrize("sizes", [None, (2_000, 3_000, 1_500)])
def test_suffix_dedup_is_the_rule(docs, rows, monkeypatch, sizes):
    if sizes:  # many batches, shards and buckets
        for name, size in zip(("BATCH_BYTES", "SHARD_BYTES", "BUCKET_BYTES"), sizes):
            monkeypatch.setattr(suffix_dedup, name, size)
    want = bag(
        (r[0], len(b), sum(f), sum(1 for k in range(len(f)) if f[k] and not (k and f[k - 1])),
         hashlib.sha256(bytes(x for x, y in zip(b, f) if not y)).hexdigest())
        for r, b, f in covered(rows))
    assert bag(tuple(r) for r in suffix_dedup.digests(docs).collect()) == want


def test_suffix_dedup_keeps_the_columns(docs, rows, none):
    want = bag((r[0], bytes(x for x, y in zip(b, f) if not y).decode("utf-8", "ignore"), r[5], r[6], r[7])
               for r, b, f in covered(rows))
    out = suffix_dedup.remove_repeats(docs)
    assert out.columns == docs.columns
    assert bag((r.doc_id, r.text, r.fp, r.batch, r.kept) for r in out.collect()) == want
    assert suffix_dedup.remove_repeats(none).count() == 0
    assert suffix_dedup.dedup(none).count() == 0


def plain_chunks(data: bytes, cfg: chunk_dedup.ChunkSettings):
    start = h = 0
    for k, x in enumerate(data):
        h = ((h << 1) + int(chunk_dedup._GEAR[x])) & 0xFFFFFFFF
        if (h & cfg.mask) == 0 and k + 1 - start >= cfg.least or k + 1 - start == cfg.most:
            yield start, k + 1
            start = k + 1
    if start < len(data):
        yield start, len(data)


def test_chunk_dedup_is_the_rule(docs, rows, none):
    cfg = chunk_dedup.ChunkSettings()
    first = {}
    for r in rows:
        b = (r[1] or "").encode()
        for x, y in plain_chunks(b, cfg):
            first[b[x:y]] = min(first.get(b[x:y], math.inf), order(r[0]))
    want = []
    for r in rows:
        b, runs = (r[1] or "").encode(), []
        for x, y in plain_chunks(b, cfg):
            if first[b[x:y]] < order(r[0]):
                if runs and runs[-1][1] == x:
                    runs[-1][1] = y
                else:
                    runs.append([x, y])
        runs = [x for x in runs if x[1] - x[0] >= cfg.least_run]
        gone = {k for x, y in runs for k in range(x, y)}
        kept = bytes(c for k, c in enumerate(b) if k not in gone)
        want.append((r[0], len(b), len(gone), len(runs), hashlib.sha256(kept).hexdigest()))
    got = chunk_dedup.digests(docs).drop("n_chunks_cut").collect()
    assert bag(tuple(r) for r in got) == bag(want)
    assert any(w[2] for w in want)
    assert chunk_dedup.dedup(none).count() == 0
    assert chunk_dedup.remove_repeats(docs).columns == docs.columns


# --- joins ----------------------------------------------------------------------------------------


def shingles(text):
    w = lower_words(text)
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


@pytest.mark.parametrize("settings", [{}, dict(block_bytes=3_000), dict(block_texts=2, hot_share=4)])
def test_ngram_classes_and_links(docs, rows, none, settings):
    sets = [shingles(r[1]) for r in rows]
    links = [[j for j, b in enumerate(sets) if i != j and a and 5 * len(a & b) >= 4 * len(a | b)] for i, a in enumerate(sets)]
    label = list(range(len(rows)))
    for _ in rows:
        label = [min([label[i], *[label[j] for j in links[i]]]) for i in range(len(rows))]
    want = []
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if label[j] == label[i] and rows[j][0] is not None]
        size = sum(1 for x in label if x == label[i])
        want.append((r[0], min(ids) if ids else None, size, len(links[i])))
    cfg = ngram_join.JoinSettings(**settings)
    assert bag(tuple(r) for r in ngram_join.classes(docs, cfg).drop("fp").collect()) == bag(want)
    kept = ngram_join.keep_one(docs, cfg)
    assert kept.columns == docs.columns
    heads = {label[i] for i in range(len(rows)) if sets[i]}
    assert kept.filter("trim(translate(text, '\n\t', '  ')) <> ''").count() == len(heads)
    assert kept.count() == len(heads) + sum(1 for s in sets if not s)
    assert ngram_join.classes(none).count() == 0 and ngram_join.keep_one(none).count() == 0


def test_many_short_near_copies(spark):
    """One group of thousands of texts of twelve windows: compared in blocks of bounded texts, every link counted."""
    n = 3000
    base = " ".join(f"w{k}" for k in range(15))
    texts = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit(base + " end"), F.col("id").cast("string")).alias("text"))
    cfg = ngram_join.JoinSettings(block_texts=400)
    got = ngram_join.classes(texts, cfg).groupBy("class_id", "class_size", "n_links").count().collect()
    assert [tuple(r) for r in got] == [(0, n, n - 1, n)]


def test_components_of_chains_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(200, 300)] + [(250, 99), (5, 5), (300, 301), (301, 300)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(100, 161), 100), **dict.fromkeys([7, 99, *range(200, 300)], 7), 300: 300, 301: 300}


def test_bands_reach_the_recall():
    cfg = ngram_join.JoinSettings()
    assert 1 - (1 - cfg.threshold**cfg.rows) ** cfg.bands >= cfg.recall


def test_leaks(spark, docs, rows, none):
    by_length = sorted((r for r in rows if r[0] is not None and len(lower_words(r[1])) > 100), key=lambda r: r[0])
    source = by_length[0]
    item = " ".join(lower_words(source[1])[20:60])
    edited = item.split()
    edited[3], edited[20] = "zzz", "yyy"
    del edited[30]
    items = [(1, item.upper() + "!"), (2, " ".join(edited)), (3, "no such words are anywhere in there at all"),
             (4, None), (5, ""), (None, item), (6, "two words")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): r.distance for r in decontaminate.find_leaks(docs, bench).collect()}
    assert got[source[0], 1] == 0 and got[source[0], 2] == 3 and got[source[0], None] == 0
    assert not {k for _, k in got} & {3, 4, 5, 6}
    texts = {}
    for r in rows:
        texts.setdefault(r[0], []).append(decontaminate_words(r[1]))
    for (d, i), distance in got.items():
        want = decontaminate_words(dict(items)[i])
        assert min(edit_distance(want, t) for t in texts[d]) == distance
    clean = decontaminate.drop_leaked(docs, bench)
    assert clean.columns == docs.columns
    leaked = {d for d, _ in got}
    assert {r.doc_id for r in clean.collect()} >= {r[0] for r in rows} - leaked
    assert source[0] not in {r.doc_id for r in clean.filter("doc_id <> 5").collect()}
    assert decontaminate.find_leaks(none, bench).count() == 0
    assert decontaminate.find_leaks(docs, bench.limit(0)).count() == 0


def decontaminate_words(text):
    import re

    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", (text or "").lower())


def edit_distance(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


# --- tokens ---------------------------------------------------------------------------------------


def test_bpe_equals_the_library(docs, rows, none):
    path = public.path("word_bpe_49k.json")
    library = tokenizers.Tokenizer.from_file(path)
    want = []
    for r in rows:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((r[0], len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert bag(tuple(r) for r in bpe.digests(docs, path).collect()) == bag(want)
    out = bpe.encode(docs, path, *docs.columns)
    assert set(out.columns) == {*docs.columns, "ids", "decoded"}
    assert bpe.digests(none, path).count() == 0


def test_token_files_round_trip(docs, rows, none):
    path = public.path("byte_bpe_50k.json")
    library = tokenizers.Tokenizer.from_file(path)
    ids = {}
    for r in rows:
        ids.setdefault(r[0], []).append([*library.encode(r[1] or "", add_special_tokens=False).ids, 2])
    got = sorted(simple8b.encode_to_files(docs, path, 2).collect(), key=lambda r: r.start)
    start = 0
    for r in got:
        assert r.start == start
        start += r.n_tokens
        crcs = [zlib.crc32(np.array(x, "<u4").tobytes()) for x in ids[r.doc_id]]
        assert r.ids_crc32 in crcs and r.n_tokens in [len(x) for x in ids[r.doc_id]]
    keys = [-math.inf if r.doc_id is None else r.doc_id for r in got]
    assert len(got) == len(rows) and keys == sorted(keys)
    assert bag((r.doc_id, r.ids_crc32) for r in got) == bag(
        (d, zlib.crc32(np.array(x, "<u4").tobytes())) for d, many in ids.items() for x in many)
    assert simple8b.encode_to_files(none, path, 2).count() == 0


@pytest.mark.parametrize("small", [False, True])
def test_language_model(docs, rows, none, monkeypatch, small):
    if small:
        monkeypatch.setattr(ngram_lm, "BATCH_BYTES", 4_000)
        monkeypatch.setattr(ngram_lm, "SHARD_BYTES", 6_000)
    cfg = ngram_lm.LmSettings()
    tokens = [[*lower_words(r[1]), None] for r in rows]
    held = [zlib.crc32(b"" if r[0] is None else str(r[0]).encode()) % 10 == 0 for r in rows]
    one, two, three = (collections.Counter() for _ in range(3))
    for w, h in zip(tokens, held):
        if not h:
            one.update(w)
            two.update(zip(w, w[1:]))
            three.update(zip(w, w[1:], w[2:]))
    total, distinct = sum(one.values()), len(one)
    least = max(2, math.ceil(cfg.context_share * total))
    code = lambda c: math.exp(ngram_lm.STEP * round(math.log(c) / ngram_lm.STEP)) if c else 0.0
    want = []
    for r, w, h in zip(rows, tokens, held):
        base = score = 0.0
        for i, x in enumerate(w):
            p = (one[x] + 0.1) / (total + 0.1 * (distinct + 1))
            base += math.log10(p)
            if i and one[w[i - 1]] >= least:
                before = one[w[i - 1]]
                p = (min(code(two[w[i - 1], x]), before) + cfg.bigram_prior * p) / (before + cfg.bigram_prior)
                if i > 1 and one[w[i - 2]] >= least:
                    pair = code(two[w[i - 2], w[i - 1]])
                    p = (min(code(three[w[i - 2], w[i - 1], x]), pair) + cfg.trigram_prior * p) / (pair + cfg.trigram_prior)
            score += math.log10(p)
        want.append((r[0], h, len(w), sum(1 for x in w if one[x]), total, round(base, 6), round(score, 6)))
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6))
           for r in ngram_lm.score(docs).collect()]
    assert bag(got) == bag(want)
    assert ngram_lm.score(none).count() == 0


def test_language_model_has_every_context(docs, rows, monkeypatch):
    """No training word is too rare to be a context: the query's settings agree with the plain model."""
    monkeypatch.setattr(ngram_lm, "BATCH_BYTES", 4_000)
    monkeypatch.setattr(ngram_lm, "SHARD_BYTES", 6_000)
    monkeypatch.setattr(text_queries, "documents", lambda spark, folder: docs)
    cfg = ngram_lm.LmSettings()
    tokens = [[*lower_words(r[1]), None] for r in rows]
    one, two, three = (collections.Counter() for _ in range(3))
    for r, w in zip(rows, tokens):
        if zlib.crc32(b"" if r[0] is None else str(r[0]).encode()) % 10:
            one.update(w)
            two.update(zip(w, w[1:]))
            three.update(zip(w, w[1:], w[2:]))
    total, distinct = sum(one.values()), len(one)
    code = lambda c: math.exp(ngram_lm.STEP * round(math.log(c) / ngram_lm.STEP)) if c else 0.0
    want, rare = [], 0
    for r, w in zip(rows, tokens):
        score = 0.0
        for i, x in enumerate(w):
            p = (one[x] + 0.1) / (total + 0.1 * (distinct + 1))
            if i:
                before = one[w[i - 1]]
                rare += before == 1
                p = (min(code(two[w[i - 1], x]), before) + cfg.bigram_prior * p) / (before + cfg.bigram_prior)
            if i > 1:
                pair = code(two[w[i - 2], w[i - 1]])
                p = (min(code(three[w[i - 2], w[i - 1], x]), pair) + cfg.trigram_prior * p) / (pair + cfg.trigram_prior)
            score += math.log10(p)
        want.append((r[0], round(score, 6)))
    got = text_queries.QUERIES["op1_ngram_lm"](docs.sparkSession, "").collect()
    assert rare and bag((r.doc_id, round(r.score, 6)) for r in got) == bag(want)


def test_language_model_messages():
    draw = np.random.default_rng(4)
    for n in (1, 560, 40_000):
        keys = np.unique(draw.integers(0, 1 << 56, n, dtype=np.uint64))
        counts = draw.geometric(0.7, len(keys)) - 1
        counts[0] = 4_000_000
        back = ngram_lm.unpack_message(ngram_lm.pack_message(keys, counts))
        assert np.array_equal(back[0], keys) and np.array_equal(back[1], counts)


# --- labels ---------------------------------------------------------------------------------------


def test_toxicity_learns_and_holds_out(spark, none):
    import random

    from corpus import prose

    draw, rows, labels = random.Random(3), [], []
    for k in range(700):
        text, toxic = prose(draw, 60), k % 5 == 0
        if toxic:
            text += f" You {draw.choice(['snorfle', 'grumbag', 'wozzelig', 'wozzelan'])}. " + prose(draw, 9)
        rows.append((k, text, "en", "s", 1, "x", 1, "k"))
        labels.append((k, 1, int(toxic)))
    rows += [(None, None, None, None, None, None, None, None), (900, "", "en", "s", 0, "", 0, "")]
    labels += [(None, 1, 1), (10_000, 1, 1), (3, None, None), (0, 1, 1)]
    docs = spark.createDataFrame(rows, COLUMNS)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    model = toxicity.fit(docs, marks)
    assert "snorfle" in model.entries and "wozze*" in model.entries
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        if r.doc_id is not None and r.doc_id < 700:
            assert r.predicted == int(r.doc_id % 5 == 0)
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns and kept.count() == 700 - 140 + 2
    assert toxicity.score(none, model).count() == 0
    empty = toxicity.fit(docs, marks.limit(0))
    assert {r.predicted for r in toxicity.score(docs, empty).collect()} == {0}


def test_grammar_lowers_negated_and_reported_and_raises_targeted():
    model = toxicity.ToxicModel({"snorfle": 2.0})
    plain = model.clause("the snorfle came".split())
    assert plain == 2.0
    assert model.clause("you are a snorfle".split()) > plain
    assert model.clause("that is not a snorfle".split()) < plain
    assert model.clause("she said snorfle".split()) < model.clause("she has snorfle".split())
    assert model.features("Nothing here. And nothing there.") == (0.0, 0.0, 0.0)


def quality_counts(text):
    text = text or ""
    w = words(text)
    seen = collections.Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    hit = {k + j for k in range(len(w) - 2) if seen[tuple(w[k : k + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in risk_rules.SYMBOLS for c in text), len(lines) - len(set(lines)), len(hit))


def test_quality_counts(spark, docs, rows, none):
    labels = spark.createDataFrame([(0, 1), (1, 0), (None, 1), (777, 1), (2, None)], "doc_id bigint, quality int")
    got = risk_rules.judge(docs, labels)
    want = []
    for r in rows:
        c = quality_counts(r[1])
        failed = c[0] < 50 or 100 * c[4] > 50 * c[0]
        want.append((r[0], *c, failed, not failed))
    assert bag(tuple(r) for r in got.collect()) == bag(want)  # too few labels for any cutoff
    plan = risk_rules.measure(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert risk_rules.judge(none, labels).count() == 0


def test_risk_control(spark):
    """Bad rows stand out by symbols; of good ones few do. Cutoffs certify the rate, and bad rows go."""
    import random

    draw, rows, labels = random.Random(4), [], []
    for k in range(6000):
        bad = k % 6 == 0
        symbols = " ###" * 40 if bad else " #" * (20 if draw.random() < 0.001 else 0)
        rows.append((k, " ".join(f"w{draw.randint(0, 10**6)}" for _ in range(60)) + symbols, "en", "s", 1, "x", 1, "k"))
        labels.append((k, 0 if bad else 1))
    docs = spark.createDataFrame(rows, COLUMNS)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int")
    kept = {r.doc_id for r in risk_rules.judge(docs, marks).filter("kept").collect()}
    good = [k for k, q in labels if q == 1]
    assert not {k for k, q in labels if q == 0} & kept
    assert len(kept & set(good)) >= 0.95 * len(good)


def test_binomial_tail_is_exact(spark):
    cases = [(100, 0, 0.01), (2000, 3, 0.0125), (5000, 30, 0.0125), (50, 50, 0.0125), (300000, 3000, 0.0125), (0, 0, 0.0125)]
    for n, k, rate in cases:
        row = spark.range(1).select(risk_rules.log_binomial_tail(
            F.lit(n).cast("bigint"), F.lit(k).cast("bigint"), rate).alias("p")).first()
        if k >= n * rate:
            assert row.p == 0.0
            continue
        logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(rate)
                + (n - i) * math.log(1 - rate) for i in range(k + 1)]
        top = max(logs)
        assert math.isclose(row.p, top + math.log(sum(math.exp(x - top) for x in logs)), rel_tol=1e-6, abs_tol=1e-9)


# --- pages ----------------------------------------------------------------------------------------


def test_page_text(spark):
    import random

    from corpus import prose

    draw, rows, want = random.Random(6), [], {}
    for k in range(60):
        body = [prose(draw, draw.randint(5, 60)) for _ in range(draw.randint(1, 6))]
        menu = "".join(f"<li><a href='/x'>{prose(draw, 1)}</a></li>" for _ in range(5))
        text = f"<html><head><title>t</title><script>var t='</p>';</script></head><body><nav><ul>{menu}</ul></nav>"
        text += f"<!-- c --><div class='ad'>{prose(draw, 8)}</div><article><h1>Head &amp; {k}</h1>"
        text += "".join(f"<p>{b[:9]}<b>{b[9:14]}</b>\n  {b[14:]}&copy;" for b in body)
        text += f"</article><footer>&copy; {prose(draw, 6)}</footer></body></html>"
        rows.append((k, f"u{k}", text, 1))
        parts = [" ".join(f"{b[:9]}{b[9:14]}\n  {b[14:]}©".split()) for b in body]
        want[k] = "\n".join([f"Head & {k}", *parts])
    rows += [(100, None, None, 1), (101, "u", "", 1), (None, "v", "<p>", 1), (0, "u0", rows[0][2], 1)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text bigint")
    got = html_blocks.extract(pages).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.text == want.get(r.page_id, "") and r.n_chars == len(r.text)
    assert html_blocks.extract(pages.limit(0)).count() == 0


def test_lstm_gradient():
    draw = np.random.default_rng(0)
    model = html_blocks.BiLstm()
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    x = draw.normal(0, 1, (2, 4, html_blocks.SIZE))
    mask = np.array([[1, 1, 1, 1], [1, 1, 0, 0]], bool)
    y = draw.integers(0, 2, (2, 4)).astype(float)

    def loss():
        p = model.predict(x, mask)
        return -(np.where(y > 0, np.log(p), np.log(1 - p)) * mask).sum() / mask.sum()

    grads = model.gradients(x, mask, y)
    for name in ("hl", "hr", "xl", "xr", "bl", "out"):
        flat = model.p[name].reshape(-1)
        k = int(np.abs(grads[name]).argmax())
        keep = flat[k]
        flat[k] = keep + 1e-2
        up = loss()
        flat[k] = keep - 1e-2
        down = loss()
        flat[k] = keep
        assert math.isclose((up - down) / 2e-2, grads[name].reshape(-1)[k], rel_tol=0.05, abs_tol=1e-4), name


def test_grammar_composes_insults_and_threats():
    model = toxicity.ToxicModel({"snorfle": 2.0})
    bare, said = model.clause(["snorfle"]), model.clause("i say snorfle".split())
    assert bare == 2.0 and said <= bare
    assert model.clause("you snorfle".split()) > bare
    assert model.clause("you are a snorfle".split()) > model.clause("you snorfle".split())
    threat = model.clause("we will kill you".split())
    assert threat > 0 and model.clause("i am going to hurt them all".split()) > 0
    for harmless in ("they kill time", "will you come", "to kill a bird", "kill", "will it kill the lights", "you will go and they kill"):
        assert model.clause(harmless.split()) == 0, harmless
    assert model.clause("we will not kill you".split()) < threat
    assert model.clause("she said we will kill you".split()) < threat * 1.5
    assert model.features("We will kill you. Nothing else.")[0] > 0
    machines = (toxicity.INSULT, toxicity.THREAT, toxicity.TARGETED, toxicity.NEGATED, toxicity.REPORTED)
    draw = np.random.default_rng(2)
    for _ in range(200):  # the composed machine walks as its parts do
        states, at = [0] * 5, 0
        for symbol in draw.integers(0, len(toxicity.SYMBOLS), 12):
            assert toxicity.GRAMMAR.gain[at] == pytest.approx(math.prod(m.gain[s] for m, s in zip(machines, states)))
            assert toxicity.GRAMMAR.adds[at] == sum(m.adds[s] for m, s in zip(machines, states))
            states = [m.moves[s][symbol] for m, s in zip(machines, states)]
            at = toxicity.GRAMMAR.moves[at][symbol]


@pytest.mark.parametrize("page,want", [
    ("<p>a</p><svg/><p>rest</p>", ["a", "rest"]),
    ("<iframe src=x/><p>rest</p>", ["rest"]),
    ("<title/><p>rest</p>", ["rest"]),
    ("<title>t</title><p>rest</p>", ["rest"]),
    ("<select><option>one<option>two<p>rest</p>", ["rest"]),
    ("<select><option>one<option>two</select><p>rest</p>", ["rest"]),
    ("<p>a</p><textarea>typed<p>rest</p>", ["a", "rest"]),
    ("<p title=it's>hello</p>", ["hello"]),
    ("<p title=\"a>b\" class='c>d'>x</p>y", ["x", "y"]),
    ("<head><p>rest</p>", ["rest"]),
    ("<script>var a='<p>x</p>';</script><p>rest", ["rest"]),
    ("<script>if (a < b) { x }<p>rest</p>", ["rest"]),
    ("a < b &amp;&amp; c > d<!-- x", ["a < b && c > d"]),
    ("<p" + " a='" * 5000, None),
])
def test_malformed_markup_keeps_the_text(page, want):
    found = [b.text for b in html_blocks.blocks(page)]
    assert want is None or found == want


def test_pages_without_telling_names():
    """Training hides the names in half of its copies: pages whose containers say nothing are read by place, words and links."""
    import random
    import re

    from corpus import prose

    draw = random.Random(8)

    def page():
        def links(n):
            return "".join(f"<li><a href='/x'>{prose(draw, draw.randint(1, 3))}</a></li>" for _ in range(n))

        body = [prose(draw, draw.randint(12, 60)) for _ in range(draw.randint(2, 9))]
        text = f"<body><header><p>{prose(draw, 3)}</p></header><nav><ul>{links(draw.randint(3, 6))}</ul></nav>"
        text += f"<article><h1>{prose(draw, 4)}</h1>" + "".join(f"<p>{b}</p>" for b in body) + "</article>"
        return text + f"<aside><ul>{links(4)}</ul></aside><footer><p>&copy; {prose(draw, 5)}</p></footer></body>"

    pages = [page() for _ in range(110)]
    model = html_blocks.train(pages[:90])
    right = wrong = missed = 0
    for p in pages[90:]:
        truth = [html_blocks.markup_label(b) for b in html_blocks.blocks(p)]
        plain = re.sub(r"<(/?)(?:header|nav|article|aside|footer)>", r"<\1div>", p)
        parsed = html_blocks.blocks(plain)
        assert len(parsed) == len(truth)
        keep = model.predict(*html_blocks.padded([html_blocks.vectors(parsed)]))[0] >= 0.5
        right += sum(k and t for k, t in zip(keep, truth))
        wrong += sum(k and not t for k, t in zip(keep, truth))
        missed += sum(t and not k for k, t in zip(keep, truth))
    assert right / (right + missed) >= 0.9 and right / (right + wrong) >= 0.9
