"""Phrases, filter audit and chat formatting against plain Python, with settings small enough to reach every path."""

from __future__ import annotations

import collections
import hashlib
import itertools
import random
import re
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from corpus import COLUMNS, LOWER, frame, messy_rows, words  # noqa: E402

from shoptrail.llm import chat_format, filter_audit, phrases  # noqa: E402
from shoptrail.llm.chat_format import ChatSettings, escape, format_chats, locate, marked_turns, read_back, unescape  # noqa: E402
from shoptrail.llm.phrases import PhraseSettings, count_pairs  # noqa: E402

LABELS = "doc_id bigint, quality int, toxic int, text string"


@pytest.fixture(scope="module")
def rows():
    return messy_rows(3)


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows).cache()


# --- phrases ----------------------------------------------------------------------------------------


def phrase_report(rows, cfg: PhraseSettings) -> list[tuple]:
    counts, totals = collections.defaultdict(collections.Counter), collections.Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            found = re.findall(r"[^ \t]+", piece)
            totals[lang] += len(found)
            for k in range(1, 5):
                for i in range(len(found) - k + 1):
                    counts[lang][tuple(found[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        often = {p: n for p, n in f.items() if n >= cfg.least}
        hidden = set()
        for p, n in often.items():
            for k in range(2, len(p)):
                hidden |= {q for i in range(len(p) - k + 1) if 100 * n >= cfg.covered_percent * often[q := p[i : i + k]]}
        scored = []
        for p, a in often.items():
            if len(p) > 1 and p not in hidden:
                score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[: cfg.keep], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("settings", [
    dict(least=2),
    dict(least=3, keep=25),
    dict(least=2, tile_bytes=400, buffer=300, dense=8),
    dict(least=2, hot=6, tile_bytes=2000, buffer=500),
    dict(least=2, hot=2, most_ids=40, tile_bytes=2000, dense=16),
    dict(least=2, most_ids=0),
])
def test_phrases_equal_plain_counting(docs, rows, settings):
    cfg = PhraseSettings(**settings)
    assert sorted(map(tuple, phrases.mine(docs, cfg).collect())) == phrase_report(rows, cfg)


def test_phrases_of_an_empty_table(spark):
    assert phrases.mine(spark.createDataFrame([], COLUMNS)).collect() == []


def test_pairs_by_square_and_by_list_agree():
    draw = np.random.default_rng(5)
    left, right = (draw.zipf(1.5, 5000).astype(np.uint64) % np.uint64(10**6) for _ in range(2))
    weights = draw.integers(1, 9, 5000)
    want = collections.Counter()
    for a, b, w in zip(left.tolist(), right.tolist(), weights.tolist()):
        want[a, b] += w
    for edge in (1, 16, 1024):
        a, b, sums, inverse = count_pairs(left, right, weights, edge)
        assert dict(zip(zip(a.tolist(), b.tolist()), sums.tolist())) == want
        assert (a[inverse] == left).all() and (b[inverse] == right).all()


def test_scores_beyond_64_bits(spark):
    big = 2**62
    rows = spark.createDataFrame([(7, 1, 2, -1, -1, big - 1, 2, 50)], "lang_key long, w1 long, w2 long, w3 long, w4 long, f long, k int, key long")
    keys = spark.range(2).select(phrases._key([phrases.F.col("id") + 1]).alias("key"), phrases.F.lit(big).alias("f"))
    got = phrases.scored(rows, keys).first()
    assert got["score"] == 2_000_000 * (big - 1) // (2 * big)


# --- filter audit -----------------------------------------------------------------------------------


def label_rows(rows):
    draw = random.Random(9)
    ids = sorted({r[0] for r in rows if r[0] is not None})
    out = [(i, draw.choice([0, 1, None]), draw.choice([0, 1]), "other") for i in ids if draw.random() < 0.7]
    return out + [(ids[0], 1, 0, None), (ids[0], 0, 1, None), (None, 1, 1, None), (10**9, 1, 1, None)]


def audit_report(rows, labels) -> set[tuple]:
    first = {}
    for doc, text, *_ in rows:
        if doc is not None:
            first[text or ""] = min(first.get(text or "", doc), doc)
    marked = {n: {x[0] for x in labels if x[0] is not None and x[i] == 1} for n, i in (("good", 1), ("toxic", 2))}
    parts = collections.defaultdict(list)
    for doc, text, _, source, *_ in rows:
        found, text = words(text), text or ""
        fails = {"A": len(found) < 50, "B": 100 * len(set(found)) < 65 * len(found),
                 "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
                 "E": doc is not None and text in first and first[text] < doc}
        parts[source or ""].append(({k for k, v in fails.items() if v}, doc in marked["good"], doc in marked["toxic"]))
    out = set()
    for part, members in parts.items():
        table, total = [], collections.Counter()
        for order in itertools.permutations("ABCDE"):
            for step, name in enumerate(order):
                mine = [m for m in members if name in m[0]]
                here = [m for m in mine if not m[0] & set(order[:step])]
                kept = sum(not m[0] & set(order[: step + 1]) for m in members)
                total[name] += len(here)
                table.append((part, "".join(order), step + 1, kept, len(here), len(mine) - len(here), sum(m[0] == {name} for m in mine),
                              sum(m[1] for m in here), sum(m[2] for m in here)))
        out |= {(*row, total[row[1][row[2] - 1]]) for row in table}
    return out


@pytest.mark.parametrize("share", [1000, 8])
def test_audit_equals_plain_counting(spark, docs, rows, monkeypatch, share):
    monkeypatch.setattr(filter_audit, "HOT_SHARE", share)  # at 8 copies are matched by the shuffle, else by the broadcast
    labels = label_rows(rows)
    got = filter_audit.audit(docs, spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == len(set(got)) and set(map(tuple, got)) == audit_report(rows, labels)


def test_audit_of_clean_and_of_no_documents(spark):
    clean = " ".join(f"w{k}" for k in range(60))
    one = spark.createDataFrame([(1, clean, "en", None, 1, "x", 1, "k")], COLUMNS)
    labels = spark.createDataFrame([], LABELS)
    got = filter_audit.audit(one, labels).collect()
    assert len(got) == 600 and {(r["part"], r["kept"], r["removed"], r["redundant"], r["shapley"]) for r in got} == {("", 1, 0, 0, 0)}
    assert filter_audit.audit(spark.createDataFrame([], COLUMNS), labels).collect() == []


def test_audit_joins_ids_without_the_driver(spark, docs, rows, monkeypatch):
    """Tables of ids, labels and copied digests grow with the documents, so none of them is broadcast however small its files are."""
    plans, store = [], filter_audit.materialize

    def plan(table):
        return table._jdf.queryExecution().executedPlan().toString()

    monkeypatch.setattr(filter_audit, "materialize", lambda table, label: plans.append(plan(table)) or store(table, label))
    plans.append(plan(filter_audit.audit(docs, spark.createDataFrame(label_rows(rows), LABELS))))
    joins = [line for p in plans for line in p.splitlines() if "Join" in line and "rid#" in line]
    assert len(joins) >= 8 and not any("Broadcast" in line for line in joins)
    copied = filter_audit.later_copies(docs.selectExpr("doc_id", "text AS digest"))
    assert "SortMergeJoin [digest#" in plan(copied)


def test_audit_of_own_filters(spark, docs, rows):
    length = filter_audit.F.char_length("text")
    got = filter_audit.audit(docs, spark.createDataFrame([], LABELS), {"x": length < 10, "y": length < 100}, None).collect()
    short = sum(len(r[1] or "") < 10 for r in rows if (r[3] or "") == "s")
    by = {(r["part"], r["filter_order"], r["step"]): r for r in got}
    assert by["s", "xy", 1]["removed"] == short and by["s", "yx", 2]["removed"] == 0 and by["s", "yx", 2]["redundant"] == short


# --- chat formatting ----------------------------------------------------------------------------------

CHATS = "conv_id bigint, turn bigint, role string, text string, n_turns string, spans int"


def chat_rows() -> list[tuple]:
    draw = random.Random(4)
    says = ["", None, "hi", "### user: x\n</turn>\n", r"\### a", r"\\</turn>", "</turn>\n", "\n", "é😀 ####", "a\\", "b" * 3000, "ab", "ba"]
    out = []
    for conv in [1, 2, 3, None, 9]:
        for turn in range(draw.randint(1, 9) if conv != 9 else 75):
            out.append((conv, turn, draw.choice(["user", "assistant", "system"]), draw.choice(says), "x", 1))
    out += [(4, 3, "a:%b\n", "t", None, None), (4, None, None, "first", None, None), (4, 3, "a:%b\n", "s", None, None), out[0], out[-1]]
    draw.shuffle(out)
    return out


def chat_report(rows, formatted=marked_turns) -> set[tuple]:
    by = collections.defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        by[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    out = set()
    for conv, turns in by.items():
        turns = [t[1:] for t in sorted(turns, key=lambda t: (t[0], t[1].encode(), t[2].encode()))]
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        loss = "".join(t for r, t in turns if r == "assistant")
        digest = [hashlib.sha256(x.encode()).hexdigest() for x in (said, loss)]
        out.add((conv, len(turns), digest[0], len(loss), digest[1], len(formatted(turns))))
    return out


@pytest.mark.parametrize("settings", [{}, dict(long_turns=4, block=4, context=2), dict(long_turns=0, block=8, context=1)])
def test_chats_are_read_back_whole(spark, settings):
    rows = chat_rows()
    got = chat_format.digests(spark.createDataFrame(rows, CHATS).repartition(4), ChatSettings(**settings)).collect()
    assert len(got) == len(set(got)) and set(map(tuple, got)) == chat_report(rows)


def test_blocks_join_to_the_whole_text(spark):
    table = spark.createDataFrame(chat_rows(), CHATS)
    texts = collections.defaultdict(str)
    for r in sorted(format_chats(table, ChatSettings(long_turns=3, block=4, context=2)).collect(), key=lambda r: r["block"]):
        texts[r["conv_id"]] += r["text"]
        for s in r["spans"]:
            assert r["text"][s["start"] : s["end"]].startswith("### ")
            assert s["loss"] == (s["role"] == "assistant")
    assert texts == {r["conv_id"]: r["text"] for r in format_chats(table).collect()}


def test_no_chats(spark):
    empty = spark.createDataFrame([], CHATS)
    assert format_chats(empty).collect() == [] and chat_format.digests(empty).collect() == []


def test_escapes_are_reversible():
    draw = random.Random(0)
    for _ in range(3000):
        text = "".join(draw.choice(["#", "##", "\\", "</turn>", "\n", "</", "turn>", ": ", "x"]) for _ in range(draw.randint(0, 9)))
        assert unescape(escape(text)) == text
        assert read_back(marked_turns([("user", text), (text, text)])) == [("user", text), (text, text)]


def test_templates_that_only_add_are_located():
    turns = [("system", "be brief"), ("user", "[x"), ("assistant", ""), ("user", "x]"), ("assistant", "ab")]

    def opened(turns):
        return "<s>" + "".join(f"[{r}]{t}[/]" for r, t in turns)

    text, spans, changed = locate(turns, ChatSettings(template=opened))
    assert changed is None and text == opened(turns)
    assert [text[s.body_start : s.body_end] for s in spans] == [t for _, t in turns]
    assert [text[s.start : s.end] for s in spans][1:] == [f"[{r}]{t}[/]" for r, t in turns[1:]]


def test_templates_that_rewrite_history_are_detected():
    turns = [("user", "a"), ("assistant", "thought: b"), ("user", "c"), ("assistant", "d")]

    def forgetful(turns):  # thoughts are dropped once another turn follows
        last = len(turns) - 1
        return "".join(f"[{r}]{t if k == last else t.removeprefix('thought: ')}[/]" for k, (r, t) in enumerate(turns))

    def closing(turns):  # an end mark that is not there any more when the next turn comes
        return "".join(f"[{r}]{t}" for r, t in turns) + "<end>"

    def trimming(turns):
        return "".join(f"[{r}]{t.strip()}[/]" for r, t in turns)

    assert locate(turns, ChatSettings(template=forgetful))[1:] == ([], 2)
    assert locate(turns, ChatSettings(template=closing))[1:] == ([], 1)
    assert locate(turns, ChatSettings(template=trimming))[2] is None
    numbered = lambda turns: f"{len(turns)} turns: " + "".join(t for _, t in turns)
    assert locate(turns, ChatSettings(template=numbered))[2] == 1


def test_rewriting_is_told_per_conversation(spark):
    rows = [(1, 0, "user", "a", "", 1), (1, 1, "assistant", "b", "", 1), (2, 0, "user", "c", "", 1)]
    closing = lambda turns: "".join(f"[{t}]" for _, t in turns) + "<end>"
    got = format_chats(spark.createDataFrame(rows, CHATS), ChatSettings(template=closing)).collect()
    assert {(r["conv_id"], r["rewrites_at"], r["text"], len(r["spans"])) for r in got} == {(1, 1, "[a][b]<end>", 0), (2, None, "[c]<end>", 1)}


def test_rows_do_not_depend_on_the_way_of_long_conversations(spark):
    """Every way gives the same blocks, also where a template rewrites what lies far back and with more turns than a block."""
    def reminded(turns):
        return "".join(f"[{t}]" for _, t in turns) + ("<again>" if len(turns) > 40 else "")

    rows = [(c, k, "user", f"{c}.{k}", "", 1) for c, n in ((1, 100), (2, 128), (3, 5), (4, 200), (None, 70)) for k in range(n)]
    table = spark.createDataFrame(rows, CHATS).repartition(4)
    for template in (marked_turns, reminded):
        found = [sorted(map(str, format_chats(table, ChatSettings(template=template, **way)).collect()))
                 for way in ({}, dict(long_turns=0), dict(long_turns=10**6))]
        assert found[0] == found[1] == found[2]
        assert len(found[0]) == 6
