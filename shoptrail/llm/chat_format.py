"""Chat formatting with a template that is only called, never looked into.

A template turns a list of (role, text) into one string. It is rendered for every prefix of a conversation: where the
output only grows, the growth is the last turn's span, and two probes with one-character texts tell where in it the text
lies. A template that changes what it has already written is found by the same comparison and reported.

A conversation is rendered in blocks of ``block`` turns, each behind a few turns before it, so no task and no rendering holds
more than a block. Conversations of over ``long_turns`` turns, or over a block, are numbered by range-partitioned ranks; a shorter one
is a single block without that. Which way it goes makes no difference to its rows.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail.llm.common import prepare
from shoptrail.operators.ranking import running_totals
from shoptrail.session import fits, materialize

Turns = list[tuple[str, str]]

# What the template writes itself, and what is therefore escaped inside texts.
HEAD, TAIL = "### ", "\n</turn>\n"
_CONTROL = re.compile(r"(###|</turn>)")
_ESCAPED = re.compile(r"\\(###|</turn>)")
_TURN = re.compile(r"### ([^:]*): (.*?)\n</turn>\n", re.DOTALL)


def escape(text: str) -> str:
    """A backslash before every control string; whatever backslashes stood there before stay."""
    return _CONTROL.sub(r"\\\1", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def _role_name(role: str) -> str:
    return role.replace("%", "%25").replace(":", "%3A").replace("\n", "%0A")


def _turn(role: str, text: str) -> str:
    return f"{HEAD}{_role_name(role)}: {escape(text)}{TAIL}"


# Successive prefixes repeat their turns; long texts are not kept.
_recent = functools.lru_cache(256)(_turn)


def marked_turns(turns: Turns) -> str:
    """The default template: a header with the role, the escaped text, an end mark on a line of its own."""
    return "".join([_recent(role, text) if len(text) < 1 << 14 else _turn(role, text) for role, text in turns])


def read_back(text: str) -> Turns:
    """The turns of a text that ``marked_turns`` wrote."""
    found, at = [], 0
    for m in _TURN.finditer(text):
        if m.start() != at:
            break
        found.append((m[1].replace("%0A", "\n").replace("%3A", ":").replace("%25", "%"), unescape(m[2])))
        at = m.end()
    if at != len(text):
        raise ValueError(f"no turn at {at}")
    return found


@dataclass(frozen=True)
class ChatSettings:
    template: Callable[[Turns], str] = marked_turns
    loss_roles: tuple[str, ...] = ("assistant",)
    # Turns up to which a conversation needs no ranks (a block at most), and block and context of rendering.
    long_turns: int = 128
    block: int = 128
    context: int = 4


@dataclass(frozen=True)
class Span:
    """Places of a turn in the formatted text, in code points; ``body`` is the text inside the turn."""

    role: str
    start: int
    end: int
    body_start: int
    body_end: int
    loss: bool


def locate(turns: Turns, cfg: ChatSettings, given: int = 0) -> tuple[str, list[Span], int | None]:
    """The formatted turns from number ``given`` on, their spans, and the first turn that changed earlier output.

    Only outputs of the template are compared. After a change no spans can be told: none are returned, and the text is the
    rendering of all turns.
    """
    before = cfg.template(turns[:given]) if given else ""
    base, spans = len(before), []
    for k in range(given, len(turns)):
        role, text = turns[k]
        after = cfg.template(turns[: k + 1])
        if not after.startswith(before):
            return cfg.template(turns)[base if given else 0 :], [], k
        one, two = (cfg.template([*turns[:k], (role, c)]) for c in "ab")
        head = None
        if one.startswith(before) and two.startswith(before) and len(one) == len(two):
            head = next((i for i in range(len(before), len(one)) if one[i] != two[i]), None)
        if head is None:
            return cfg.template(turns)[base if given else 0 :], [], k
        tail = len(one) - head - 1
        body_end = len(after) - tail
        if body_end < head or after[:head] != one[:head] or after[body_end:] != one[head + 1 :]:
            return cfg.template(turns)[base if given else 0 :], [], k  # the template changes texts by more than escapes
        spans.append(Span(role, len(before) - base, len(after) - base, head - base, body_end - base, role in cfg.loss_roles))
        before = after
    return before[base:], spans, None


_SPAN = "struct<role:string,start:bigint,end:bigint,body_start:bigint,body_end:bigint,loss:boolean>"
_FORMATTED = f"conv_id bigint, block bigint, n_turns bigint, text string, rewrites_at bigint, spans array<{_SPAN}>"
_SPAN_TYPE = pa.struct([("role", pa.string()), *[(n, pa.int64()) for n in ("start", "end", "body_start", "body_end")], ("loss", pa.bool_())])
_SCHEMA = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("n_turns", pa.int64()), ("text", pa.string()),
                     ("rewrites_at", pa.int64()), ("spans", pa.list_(_SPAN_TYPE))])


def _units(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple, Turns, int]]:
    """Runs of rows of one conversation and block, with the number of context turns at their start."""
    key, turns, given = None, [], 0
    for batch in batches:
        rows = zip(*[batch.column(c).to_pylist() for c in ("conv_id", "block", "earlier", "role", "text")])
        for conv, block, earlier, role, text in rows:
            if (conv, block) != key:
                if turns:
                    yield key, turns, given
                key, turns, given = (conv, block), [], 0
            turns.append((role, text))
            given += earlier
    if turns:
        yield key, turns, given


def _formatted(rows: DataFrame, cfg: ChatSettings) -> DataFrame:
    """rows: conv_id, block, earlier, turn, role, text. Units stream through their tasks one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for (conv, block), turns, given in _units(batches):
            text, spans, changed = locate(turns, cfg, given)
            out.append({"conv_id": conv, "block": block, "n_turns": len(turns) - given, "text": text, "rewrites_at": changed,
                        "spans": [vars(s) for s in spans]})
            size += len(text)
            if size > 1 << 20:
                yield pa.RecordBatch.from_pylist(out, schema=_SCHEMA)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_SCHEMA)

    dealt = rows.repartition("conv_id", "block")
    ordered = dealt.sortWithinPartitions("conv_id", "block", F.desc("earlier"), "turn", "role", "text")
    return ordered.mapInArrow(run, _FORMATTED)


def _clean(conversations: DataFrame) -> DataFrame:
    return conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def _blocks(rows: DataFrame, cfg: ChatSettings) -> DataFrame:
    """Turns of long conversations by blocks, the last ones of a block once more before the next."""
    order = [F.asc("turn"), F.asc("role"), F.asc("text"), F.asc("row")]
    placed = running_totals(rows.withColumn("row", F.monotonically_increasing_id()), ["conv_no"], order, [])
    at = F.col("position") - 1
    block = F.floor(at / cfg.block)
    again = F.when(at % cfg.block >= cfg.block - cfg.context, F.struct((block + 1).alias("block"), F.lit(1).alias("earlier")))
    both = F.array_compact(F.array(F.struct(block.alias("block"), F.lit(0).alias("earlier")), again))
    exploded = placed.withColumn("u", F.explode(both)).select("conv_id", "u.*", "turn", "role", "text")
    return exploded


def format_chats(conversations: DataFrame, cfg: ChatSettings | None = None) -> DataFrame:
    """conv_id, block, n_turns, text, rewrites_at, spans: one row per block of a conversation.

    A conversation's formatted text is that of its blocks in their order; places are counted from the start of the block. Rows
    are taken by turn (nulls first), ties by role and text, repeated rows each. Null roles and texts are empty; rows without conv_id
    are one conversation; other columns are ignored; no rows give no rows. ``rewrites_at`` numbers, within the unit, the turn whose
    rendering changed earlier output, or whose text the template does not keep: such a unit has no spans. An empty
    block that only holds context is left out.
    """
    light, heavy = _split(_clean(conversations), cfg or ChatSettings())
    return light if heavy is None else light.unionByName(heavy)


def _split(rows: DataFrame, cfg: ChatSettings) -> tuple[DataFrame, DataFrame | None]:
    spark = prepare(rows.sparkSession)
    counts = rows.groupBy("conv_id").agg(F.count("*").alias("n"))
    long_ones = materialize(
        counts.filter(F.col("n") > min(cfg.long_turns, cfg.block)).select(F.col("conv_id").alias("conv_no")), "long-conversations")
    if long_ones.isEmpty():
        return _formatted(_whole(rows), cfg), None
    known = F.broadcast(long_ones) if fits(long_ones, 1_000_000) else long_ones
    same = rows["conv_id"].eqNullSafe(known["conv_no"])
    light = _formatted(_whole(rows.join(known, same, "left_anti")), cfg)
    marked = rows.join(known, same, "left_semi").withColumn("conv_no", F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
    heavy = _formatted(_blocks(marked, cfg), cfg).filter("n_turns > 0")
    return light, heavy


def _whole(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"block": F.lit(0).cast("bigint"), "earlier": F.lit(0)})


# --- digests, read back from the formatted rows ---------------------------------------------------------


def digests(conversations: DataFrame, cfg: ChatSettings | None = None) -> DataFrame:
    """Per conversation, from its formatted text and spans alone: number and sha256 of the turns read back, number and
    sha256 of the code points under the loss mask, and the length of the formatted text.

    Needs a template that ``read_back`` can read. A long conversation's blocks stream through one task in their order,
    as its digest is one chain over all of them; the task holds one block at a time.
    """
    light, heavy = _split(_clean(conversations), cfg or ChatSettings())
    schema = ("conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
    found = light.select("conv_id", "text", "spans").mapInArrow(_digest, schema)
    if heavy is not None:
        ordered = heavy.repartition("conv_id").sortWithinPartitions("conv_id", "block").select("conv_id", "text", "spans")
        found = found.union(ordered.mapInArrow(_digest, schema))
    return found


def _digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, state, out = (), None, []

    def done() -> tuple:
        return key[0], state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def packed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    for batch in batches:
        for conv, text, spans in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "text", "spans")]):
            if (conv,) != key:
                if state:
                    out.append(done())
                key, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, said in read_back(text):
                state[0] += 1
                state[1].update(f"{role}\n{said}\n".encode())
            for span in spans:
                if span["loss"]:
                    said = unescape(text[span["body_start"] : span["body_end"]])
                    state[2] += len(said)
                    state[3].update(said.encode())
            state[4] += len(text)
        if len(out) > 1000:
            yield packed()
            out = []
    if state:
        out.append(done())
    if out:
        yield packed()
