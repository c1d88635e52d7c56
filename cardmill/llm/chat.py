"""Chat formatting in budgeted windows.

A turn is written as ``<|turn|>role<|text|>text<|end|>``. Inside roles and texts a backslash is doubled, and a control
string (of this template or of common others) gets a backslash after its first character; both are undone by one
replacement, so any text survives.

The turns of a conversation are numbered without gaps, however many there are, and cut into segments of ``SEGMENT``
turns. Within a segment, prefix sums of the turns' tokens choose the longest span of whole turns that fits the budget;
a turn that alone exceeds it gets a window of its own. Each window repeats the system turn that opens the conversation
and up to ``HISTORY`` turns before its span, as far as they fit. Only assistant turns of the span itself are trained
on: the mask leaves out repeated turns, so every assistant text is a target once.

Tokens are counted as words plus the three control strings of a turn. Null texts and roles are empty. Turns are ordered
by turn, role and text; equal rows are repeated. Rows with a null key are one conversation. Empty tables give no rows.
Only the four named columns are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from cardmill.llm.tables import numbered, read, ready

BUDGET = 1024
HISTORY = 2
SEGMENT = 512
# Fixed: strings that end or open a turn in this template or in common ones.
CONTROL = r"<\||</?s>|\[/?INST\]|<</?SYS>>"
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
COLUMNS = ("id", "place", "target", "head", "body", "tokens", "system", "segment", "lead")
ID, PLACE, TARGET, HEAD, BODY, TOKENS, SYSTEM, SEGMENT_AT, LEAD = range(len(COLUMNS))


def escaped(column) -> F.Column:
    doubled = F.regexp_replace(F.coalesce(column, F.lit("")), r"\\", r"\\\\")
    return F.regexp_replace(doubled, rf"([<\[])(?=(?<=<)\||(?<=<)/?s>|(?<=\[)/?INST\]|(?<=<)</?SYS>>)", r"$1\\")


def unescaped(column) -> F.Column:
    return F.regexp_replace(column, r"\\(\\?)", "$1")


def spans(tokens: np.ndarray, system: int, first: int, budget: int, history: int):
    """(first, end, first repeated turn) of each window; ``first`` turns at the start are only there as history."""
    ends = np.cumsum(tokens)
    start = first
    while start < len(tokens):
        before = ends[start - 1] if start else 0
        room = budget - (system if start or first else 0)
        again = start
        while again > max(0, start - history) and before - (ends[again - 2] if again > 1 else 0) + tokens[start] <= room:
            again -= 1
        used = ends[again - 1] if again else 0
        end = max(start + 1, int(np.searchsorted(ends, used + room, side="right")))
        yield start, end, again
        start = end


def windows(
    turns: DataFrame, key="conv_id", turn="turn", role="role", text="text", budget=BUDGET, history=HISTORY, segment=SEGMENT
) -> DataFrame:
    """Formatted windows: key, window, formatted, n_turns, n_repeated, mask (start and end code points of targets)."""
    plain = turns.select(F.col(key).alias("id"), F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))
    placed = numbered(plain, ["id"], ["turn", "role", "text"], "place")
    placed = placed.select(
        "id", "place", (F.col("role") == "assistant").alias("target"), F.concat(F.lit(TURN), escaped(F.col("role")), F.lit(TEXT)).alias("head"),
        escaped(F.col("text")).alias("body"), (F.regexp_count("text", F.lit("\\S+")) + 3).cast("long").alias("tokens"), (F.col("role") == "system").alias("system"),
    )
    part = F.floor(F.col("place") / segment)
    own = placed.withColumns({"segment": part, "lead": F.lit(0)})
    # The last turns of a segment are history for the next one, if that one has turns.
    tail = own.filter(F.col("place") % segment >= segment - history).withColumns({"segment": F.col("segment") + 1, "lead": F.lit(1)})
    opening = own.filter("place = 0 and system").select(F.col("id").alias("__id"), F.lit(2).alias("lead"), "head", "body", "tokens", "target", "system")
    later = own.filter(f"place % {segment} = 0 and place > 0").select("id", "place", "segment")
    system = later.join(opening, F.col("id").eqNullSafe(F.col("__id")))
    rows = own.union(tail).unionByName(system.select("id", "place", "target", "head", "body", "tokens", "system", "segment", "lead"))

    def one_segment(lines: list[tuple]):
        """Windows of the lines of one segment: those of the opening system turn first, the others by place."""
        opening = [x for x in lines if x[LEAD] == 2][:1]
        lines = [x for x in lines if x[LEAD] < 2]
        lead = sum(x[LEAD] for x in lines)
        if lead == len(lines):
            return
        opens = lines[0][SYSTEM] and lines[0][PLACE] == 0
        first = lines[:1] if opens else opening
        system, cost = ("".join((first[0][HEAD], first[0][BODY], END)), first[0][TOKENS]) if first else ("", 0)
        for start, end, again in spans(np.array([x[TOKENS] for x in lines]), cost, lead, budget, history):
            if opens and start:
                again = max(again, 1)  # the system turn is put in front, not repeated as history
            parts = [system] if system and not (opens and start == 0) else []
            repeated, mask, at = len(parts) + start - again, [], sum(map(len, parts))
            for i, x in enumerate(lines[again:end], again):
                body_at = at + len(x[HEAD])
                at = body_at + len(x[BODY]) + len(END)
                if i >= start and x[TARGET]:
                    mask.append({"low": body_at, "high": body_at + len(x[BODY])})
                parts += [x[HEAD], x[BODY], END]
            yield lines[start][ID], lines[start][PLACE], "".join(parts), end - start, repeated, mask

    def run(batches):
        for lines in _grouped(batches, (ID, SEGMENT_AT)):
            made = list(one_segment(lines))
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made), arrow)], schema=arrow)

    kind = plain.schema["id"].dataType
    schema = StructType().add("id", kind)
    for name, of in (("window", LongType()), ("formatted", StringType()), ("n_turns", LongType()), ("n_repeated", LongType())):
        schema = schema.add(name, of)
    schema = schema.add("mask", ArrayType(StructType().add("low", LongType()).add("high", LongType())))
    arrow = to_arrow_schema(schema)
    # A segment is bounded, and a task sees one at a time.
    dealt = rows.select(*COLUMNS).repartition("id", "segment").sortWithinPartitions("id", "segment", (F.col("lead") < 2), "place")
    return dealt.mapInArrow(run, schema).withColumnRenamed("id", key)


def _grouped(batches, keys: tuple[int, ...]):
    """Rows of each run of equal keys as tuples; a run may span batches."""
    now, held = None, []
    for batch in batches:
        for line in zip(*(column.to_pylist() for column in batch.columns)):
            if held and now != tuple(line[k] for k in keys):
                yield held
                held = []
            now = tuple(line[k] for k in keys)
            held.append(line)
    if held:
        yield held


def digests(formatted: DataFrame, key="conv_id") -> DataFrame:
    """What can be read back from the windows of each conversation.

    Windows are sorted by conversation and place and fed to running digests, so a task holds a batch of windows and no
    conversation as a whole.
    """
    turns = F.slice(F.split("formatted", r"<\|turn\|>"), F.col("n_repeated").cast("int") + 2, F.col("n_turns").cast("int"))
    halves = F.transform(turns, lambda t: F.split(F.regexp_replace(t, r"<\|end\|>$", ""), r"<\|text\|>"))
    read_back = F.array_join(F.transform(halves, lambda h: F.concat(unescaped(h[0]), F.lit("\n"), unescaped(h[1]), F.lit("\n"))), "")
    target = F.array_join(F.transform("mask", lambda m: unescaped(F.substr("formatted", (m["low"] + 1).cast("int"), (m["high"] - m["low"]).cast("int")))), "")
    rows = formatted.select(F.col(key).alias("id"), "window", "n_turns", F.length("formatted").cast("long").alias("chars"), read_back.alias("turns"), target.alias("loss"))
    schema = StructType().add("id", rows.schema["id"].dataType)
    for name, of in (("n_turns", LongType()), ("turns_sha256", StringType()), ("loss_chars", LongType()), ("loss_sha256", StringType()), ("formatted_chars", LongType())):
        schema = schema.add(name, of)
    arrow = to_arrow_schema(schema)

    def fold(batches):
        now, state = None, None
        for batch in batches:
            done = []
            for id_, _, n, chars, text, loss in zip(*(column.to_pylist() for column in batch.columns)):
                if state is None or now != id_:
                    if state is not None:
                        done.append((now, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))
                    now, state = id_, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[0] += n
                state[1].update(text.encode())
                state[2] += len(loss)
                state[3].update(loss.encode())
                state[4] += chars
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), arrow)], schema=arrow)
        if state is not None:
            last = (now, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])
            yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(last, arrow)], schema=arrow)

    return rows.repartition("id").sortWithinPartitions("id", "window").mapInArrow(fold, schema).withColumnRenamed("id", key)


def op8_chat(spark, folder: str) -> DataFrame:
    ready(spark)
    turns = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    # Fixed: the conversation that every run formats besides the table's.
    probe = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)], "conv_id long, turn long, role string, text string")
    return digests(windows(turns.unionByName(extra)))


SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, unnest([0, 1]), unnest(['user', 'assistant']), '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256
FROM t GROUP BY conv_id
"""
