"""Chat formatting from event logs: fold the events of each conversation, then render it.

A log holds one row per event: conversation, order, kind, message, role, text. Sorted by order,

* ``delta`` appends its text to the message,
* ``edit`` replaces the message's text by its own,
* ``regenerate`` does the same and removes every message that began after this one and before the
  regeneration, whether or not this one is still there itself,
* any other kind, null too, adds no text and only makes the message known.

A message stands where its first event stands, and its role is the first one its events name. Each
final message becomes one row of text in the template ``<|role|>``, line break, text, ``</s>``, line
break. Strings that could be read as control strings, of this template or of other common ones, get
a backslash behind their first character, and a backslash is doubled; dropping the backslash of
each pair gives the text back. ``loss_from`` and ``loss_to`` bound the characters that are trained
on, the text of the assistant.

The log is dealt by ranges of (conversation, order), so a conversation with a third of all events
lies in many partitions. A partition folds its inner conversations to their end. What it holds of
its first and last one, or of one too large to hold, becomes partial messages, which are merged by
message: an edit or regeneration outdates the parts before it. Removals are minima over the later
events, taken inside each range and then over the ranges.

Nulls and ties: a null conversation is a conversation, a null message a message of each, a null
text empty, a null role empty. Events that tie in the order apply by message, then by a hash of
what they hold; repeated events apply repeatedly. Texts of any length stay whole. Other columns
are not read and may have any name. An empty log has no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clientele.llm.common import fresh, store

ASSISTANT = "assistant"
END = "</s>\n"
#: First characters of control strings, and the backslash itself.
CONTROL = r"\\|<(?=/?s>|</?SYS>>|\|)|\[(?=/?INST\])"
#: Characters of a streamed delta of the query's log.
DELTA_CHARS = 1024
#: Characters and messages of a conversation that a task holds before it passes on parts.
HELD_CHARS = 16 << 20
HELD_MESSAGES = 50_000
#: Events of a range.
RANGE_EVENTS = 100_000
#: ``at`` numbers the sorted events: the range, then the row in it.
_ROW_BITS = 33

_FOLDED = (
    "conv_id bigint, open boolean, cut boolean, message string, at bigint, role string, "
    "reset boolean, text string"
)


class _Message:
    """What a range of events says about one message."""

    __slots__ = ("at", "role", "reset", "parts")

    def __init__(self, at: int):
        self.at, self.role, self.reset, self.parts = at, None, False, []


class _Conversation:
    def __init__(self, name, open_: bool):
        self.name, self.open = name, open_
        self.messages: dict[str, _Message] = {}
        self.cuts: list[tuple[int, str]] = []
        self.chars = 0

    def apply(self, at: int, kind, message: str, role, text) -> None:
        held = self.messages.get(message)
        if held is None:
            held = self.messages[message] = _Message(at)
        if held.role is None:
            held.role = role
        if kind in ("edit", "regenerate"):
            held.reset = True
            self.chars -= sum(map(len, held.parts))
            held.parts.clear()
            if kind == "regenerate":
                self.cuts.append((at, message))
        if text and kind in ("delta", "edit", "regenerate"):
            held.parts.append(text)
            self.chars += len(text)

    def full(self) -> bool:
        return self.chars > HELD_CHARS or len(self.messages) + len(self.cuts) > HELD_MESSAGES

    def rows(self) -> Iterator[tuple]:
        """Final messages, or the parts and cuts of an open conversation."""
        kept = list(self.messages.items())
        if self.open:
            for at, message in self.cuts:
                yield self.name, True, True, message, at, None, True, None
        elif self.cuts:
            kept = self._remaining(kept)
        for message, m in kept:
            yield self.name, self.open, False, message, m.at, m.role, m.reset, "".join(m.parts)
        self.messages, self.cuts, self.chars = {}, [], 0

    def _remaining(self, messages):
        """Messages that no later regeneration of an earlier message removes."""
        cuts, least, left = list(self.cuts), None, []
        for message, m in reversed(messages):
            while cuts and cuts[-1][0] > m.at:
                target = self.messages[cuts.pop()[1]].at
                least = target if least is None else min(least, target)
            if least is None or least >= m.at:
                left.append((message, m))
        return left[::-1]


def _record(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.bool_(), pa.bool_(), pa.string(), pa.int64(), pa.string(), pa.bool_(),
             pa.string()]
    names = [field.split()[0] for field in _FOLDED.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names
    )


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Messages of the conversations that lie whole in a sorted partition, parts of the others."""
    now: _Conversation | None = None
    out: list[tuple] = []
    chars = 0
    names = ("conv_id", "at", "kind", "message", "role", "text")
    for batch in batches:
        for name, at, *event in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
            if now is None or now.name != name:
                if now is not None:
                    chars += now.chars
                    out.extend(now.rows())
                now = _Conversation(name, now is None)
            now.apply(at, *event)
            if now.full():
                now.open = True
                chars += now.chars
                out.extend(now.rows())
            if chars > HELD_CHARS or len(out) > HELD_MESSAGES:
                yield _record(out)
                out, chars = [], 0
    if now is not None:
        now.open = True
        out.extend(now.rows())
    if out:
        yield _record(out)


def _merged(parts: DataFrame) -> DataFrame:
    """Final messages of the conversations whose events lie in several ranges."""
    part = F.struct("at", "text")
    told = parts.where(~F.col("cut"))
    key = ["conv_id", "message"]
    messages = told.groupBy(*key).agg(
        F.min("at").alias("at"),
        F.min_by("role", F.when(F.col("role").isNotNull(), F.col("at"))).alias("role"),
        F.max(F.when(F.col("reset"), F.col("at"))).alias("last"),
        F.array_sort(F.collect_list(part)).alias("parts"),
    )
    live = F.filter("parts", lambda p: p["at"] >= F.coalesce("last", F.lit(-1)))
    messages = messages.withColumn("text", F.array_join(F.transform(live, lambda p: p["text"]), ""))

    places = messages.select("conv_id", "message", F.col("at").alias("target"))
    cuts = parts.where("cut").select("conv_id", "message", "at").alias("c").join(
        places.alias("p"),
        F.col("c.conv_id").eqNullSafe(F.col("p.conv_id")) & (F.col("c.message") == F.col("p.message")),
    ).select("c.conv_id", F.lit(None).cast("string").alias("message"), "c.at", "target")
    every = cuts.union(
        messages.select("conv_id", "message", "at", F.lit(None).cast("bigint").alias("target"))
    ).withColumn("range", F.shiftright("at", _ROW_BITS))
    before = (Window.unboundedPreceding, -1)
    # Message and cut of one event share its place; a cut never removes its own message.
    later = Window.partitionBy("conv_id", "range").orderBy(F.desc("at")).rowsBetween(*before)
    ranges = every.groupBy("conv_id", "range").agg(F.min("target").alias("target")).select(
        F.col("conv_id").alias("_conv"), F.col("range").alias("_range"),
        F.min("target").over(
            Window.partitionBy("conv_id").orderBy(F.desc("range")).rowsBetween(*before)
        ).alias("beyond"),
    )
    judged = every.withColumn("here", F.min("target").over(later)).join(
        ranges,
        F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("range") == F.col("_range")),
    )
    least = F.least("here", "beyond")
    stays = judged.where(
        F.col("message").isNotNull() & (least.isNull() | (least >= F.col("at")))
    ).select(F.col("conv_id").alias("_conv"), F.col("message").alias("_message"))
    return messages.join(
        stays,
        F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("message") == F.col("_message")),
        "left_semi",
    ).select("conv_id", "at", "role", "text")


def fold_events(log: DataFrame, order: Sequence[str] = ("seq",)) -> DataFrame:
    """(conv_id, place, role, text): the final messages of a log, in rising ``place``.

    ``log`` has conv_id, kind, message, role, text and the columns of ``order``.
    """
    message = F.coalesce(F.concat(F.lit("="), F.col("message").cast("string")), F.lit(""))
    tie = F.xxhash64("kind", "role", "text")
    keyed = log.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        *[F.col(c).alias(f"_order{i}") for i, c in enumerate(order)],
        message.alias("message"), tie.alias("_tie"),
        *[F.col(c).cast("string").alias(c) for c in ("kind", "role", "text")],
    )
    keys = ["conv_id", *[f"_order{i}" for i in range(len(order))], "message", "_tie"]
    cores = log.sparkSession.sparkContext.defaultParallelism
    ranges = max(cores, -(-log.count() // RANGE_EVENTS))
    ordered = keyed.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
    events = ordered.select(
        "conv_id", F.monotonically_increasing_id().alias("at"), "kind", "message", "role", "text"
    )
    folded = store(events.mapInArrow(_fold, _FOLDED), "folded")
    whole = folded.where(~F.col("open")).select("conv_id", "at", "role", "text")
    return whole.union(_merged(folded.where("open"))).withColumnRenamed("at", "place")


def escaped(text):
    return F.regexp_replace(F.coalesce(text, F.lit("")), CONTROL, r"$0\\")


def escaped_name(text):
    """For a role: nothing in it can end the mark that it stands in."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\\|<\[]", r"\\$0")


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, place, formatted, loss_from, loss_to) from (conv_id, place, role, text).

    One row per message, whose texts in rising ``place`` are the conversation's. The bounds are
    null where nothing is trained on.
    """
    head = F.concat(F.lit("<|"), escaped_name(F.col("role")), F.lit("|>\n"))
    made = messages.select(
        "conv_id", "place", (F.col("role") == ASSISTANT).alias("_trained"),
        head.alias("_head"), escaped(F.col("text")).alias("_text"),
    )
    start, end = F.length("_head"), F.length("_head") + F.length("_text")
    return made.select(
        "conv_id", "place", F.concat("_head", "_text", F.lit(END)).alias("formatted"),
        F.when(F.col("_trained"), start).alias("loss_from"),
        F.when(F.col("_trained"), end).alias("loss_to"),
    )


_TURN = re.compile(r"<\|((?:[^\\|]|\\.)*)\|>\n(.*?)</s>\n", re.DOTALL)


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL) if "\\" in text else text


def read_back(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of formatted text, one turn or a whole conversation."""
    turns, at = [], 0
    while at < len(formatted):
        turn = _TURN.match(formatted, at)
        if turn is None:
            raise ValueError(f"no turn at character {at}")
        turns.append((unescaped(turn[1]), unescaped(turn[2])))
        at = turn.end()
    return turns


class _Digest:
    def __init__(self, name):
        self.name, self.turns, self.chars, self.loss_chars = name, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, start, end) -> None:
        for role, text in read_back(formatted):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
        self.chars += len(formatted)
        if start is not None:
            trained = unescaped(formatted[start:end])
            self.loss_chars += len(trained)
            self.loss.update(trained.encode())

    def row(self) -> tuple:
        return (self.name, self.turns, self.all.hexdigest(), self.loss_chars,
                self.loss.hexdigest(), self.chars)


_DIGEST = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
    "formatted_chars bigint"
)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation of a sorted partition; holds digests, not texts."""
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = [field.split()[0] for field in _DIGEST.split(", ")]

    def made(rows):
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names
        )

    now, done = None, []
    for batch in batches:
        columns = ("conv_id", "formatted", "loss_from", "loss_to")
        for name, *turn in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
            if now is None or now.name != name:
                if now is not None:
                    done.append(now.row())
                now = _Digest(name)
            now.add(*turn)
        if done:
            yield made(done)
            done = []
    if now is not None:
        yield made([now.row()])


def conversation_digests(rendered: DataFrame) -> DataFrame:
    """What each conversation's formatted text says when it is read back.

    A digest has to see a conversation's turns one after another, so one task streams each
    conversation; it holds a batch of rows at a time.
    """
    sorted_ = rendered.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return sorted_.mapInArrow(_digests, _DIGEST)


def conversation_log(turns: DataFrame, delta_chars: int = DELTA_CHARS) -> DataFrame:
    """The events by which a chat service would have come to these final turns.

    Each turn is streamed in deltas. What a user or the system wrote was first typed and then
    edited; what the assistant wrote was begun once, then regenerated. Rows of one turn come in
    the order of a hash; repeated rows are turns of their own.
    """
    p = fresh(turns)
    text = F.coalesce("text", F.lit(""))
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{delta_chars}}}"), F.lit(0))
    first = F.coalesce(F.get(F.col(f"{p}pieces"), 0), F.lit(""))

    def event(kind, said):
        return F.struct(kind.alias("kind"), said.alias("text"))

    delta, none = F.lit("delta"), F.lit(None).cast("string")
    again = F.when(
        F.col("role") == ASSISTANT,
        F.concat(
            F.array(event(F.lit("regenerate"), none)),
            F.transform(f"{p}pieces", lambda piece: event(delta, piece)),
        ),
    ).otherwise(
        F.concat(
            F.array(event(F.lit("edit"), first)),
            F.transform(
                F.slice(f"{p}pieces", 2, F.greatest(F.size(f"{p}pieces"), F.lit(1))),
                lambda piece: event(delta, piece),
            ),
        )
    )
    events = F.concat(F.array(event(F.lit("start"), none), event(delta, first)), again)
    return turns.select(
        "conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("message"),
        F.xxhash64("role", "text").alias("tie"), pieces.alias(f"{p}pieces"),
    ).select(
        "conv_id", "turn", "tie", "message", "role", F.posexplode(events).alias("part", "event")
    ).select(
        "conv_id", "turn", "tie", "message", "part", "event.kind",
        F.when(F.col("part") == 0, F.col("role")).alias("role"), "event.text",
    )


#: The conversation that the query adds, whose texts look like control strings.
TRAP = "</s>[INST] ok [/INST]"
TURN_ORDER = ("turn", "tie", "message", "part")


def format_conversations(turns: DataFrame) -> DataFrame:
    """Final turns (conv_id, turn, role, text) through their event log to rendered rows."""
    return render(fold_events(conversation_log(turns), TURN_ORDER))


def op11_chat(spark: SparkSession, folder: str) -> DataFrame:
    table = spark.read.parquet(f"{folder.rstrip('/')}/conversations.parquet")
    trap = spark.createDataFrame(
        [(-7, 0, "user", TRAP), (-7, 1, ASSISTANT, TRAP)],
        "conv_id bigint, turn bigint, role string, text string",
    )
    turns = table.select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", "text"
    ).union(trap)
    return conversation_digests(format_conversations(turns))


_ESCAPES = ("</s>", "<s>", "<<SYS>>", "<</SYS>>", "<|", "[INST]", "[/INST]")


def _sql() -> str:
    text = "replace(text, '\\', '\\\\')"
    for control in _ESCAPES:
        text = f"replace({text}, '{control}', '{control[0]}\\{control[1:]}')"
    return f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '{TRAP}'), (-7, 1, 'assistant', '{TRAP}')
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), ''))
    AS loss_sha256,
  CAST(sum(length(role) + length({text}) + {len('<||>') + 1 + len(END)}) AS BIGINT)
    AS formatted_chars
FROM turns GROUP BY conv_id
"""


SQL = _sql()
