"""A small corpus with the awkward cases, and the plain rules that operators are compared with."""

from __future__ import annotations

import random
import re

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, fp string, batch bigint, kept string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SYLLABLES = "an re th on er in ea st ou ti ble ha wh or nd".split()


def prose(draw: random.Random, words: int) -> str:
    parts = ["".join(draw.choice(SYLLABLES) for _ in range(draw.randint(1, 3))) for _ in range(words)]
    return " ".join(p.capitalize() + "." if k % 9 == 8 else p for k, p in enumerate(parts))


def messy_rows(seed: int = 1) -> list[tuple]:
    """Nulls everywhere, empty and blank texts, copies, near copies, shared passages, repeated ids, one long text."""
    draw = random.Random(seed)
    passage = prose(draw, 70)
    base = prose(draw, 120)
    texts = [prose(draw, draw.randint(1, 160)) for _ in range(30)]
    texts += [base, base, base + " Éç ende.", base.replace("an", "AN", 1), "x " + base, base[: len(base) // 2]]
    texts += [prose(draw, 30) + " " + passage + " " + prose(draw, 20) for _ in range(4)]
    texts += ["", " \n\t", "a", "a b c", "a b c", "é" * 60, "é" * 61, "ab" * 80, "a\x0bb\x0cc\rd", "ü" + passage]
    texts += [prose(draw, 3000), "\n".join([prose(draw, 8)] * 12), "😀 " * 40]
    rows = [(k, t, draw.choice(["en", "de", None]), "s", len(t), "x", 7, "k") for k, t in enumerate(texts)]
    rows += [(5, prose(draw, 60), "en", None, None, None, None, None), (5, rows[5][1], None, "s", 1, "x", 7, "k")]
    rows += [(None, base, "en", "s", 1, "x", 7, "k"), (None, None, None, None, None, None, None, None), (900, None, "en", "s", 0, "", 0, "")]
    rows += [rows[30], (None, "x y " + base, "en", "s", 1, "x", 7, "k"), (None, "x y " + base, None, "s", 1, "x", 7, "k")]
    alone = prose(draw, 90)  # near copies of which none has an id
    rows += [(None, alone + end, "en", "s", 1, "x", 7, "k") for end in ("", " one", " two")]
    draw.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, COLUMNS).repartition(5)


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower_words(text: str | None) -> list[str]:
    return words((text or "").translate(LOWER))


def order(doc_id: int | None) -> float:
    return float("inf") if doc_id is None else doc_id
