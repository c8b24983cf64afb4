"""Chat formatting in budgeted windows.

A turn is written `<|turn|>role`, a line feed, the text, `<|end|>` and a line feed. Control strings
of this and other templates inside a text are broken by a backslash behind their first
character, and backslashes are doubled, which `unescape` reverts.

Prefix sums of the turns' tokens, within blocks of turn numbers and then over blocks, give
each turn its place in its conversation. The places are cut into cells of `stride` tokens; a window has
the turns that begin in a cell, but a turn that crosses into the next cell and is longer
than `longest` tokens is a window of its own. So windows are turn-aligned, need no pass over
a whole conversation, and hold at most stride + longest tokens of their own (a longer turn excepted).
Every window but the first repeats the system turn, if the first turn is one, and up to
`history_turns` turns before it of `history` tokens together. Repeated turns are context: only
a window's own assistant texts are under the loss mask, each once over all windows.

Defined results: turns are ordered by turn, then by their formatted text; turns without a number come first, in the
order of a hash of their formatted text, so that they fall into blocks too. Null texts and roles are empty; a null conv_id is a
conversation of its own. Repeated rows are turns each. Very long texts are whole turns. Other columns aren't looked at.
The tokenizer's file is a parameter; the driver reads it and sends it to the executors.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomcat.llm.common import mapped, written

STRIDE, LONGEST, HISTORY, HISTORY_TURNS = 1024, 512, 256, 2
BLOCK, LOOSE = 128, 1024  # turns that a block has by number; blocks of turns without a number
TURN, END = "<|turn|>", "<|end|>"
# Control strings of chat templates; every <| is one.
CONTROL = re.compile(r"\\|<(?=\||s>|/s>|<SYS>>|</SYS>>|start_of_turn>|end_of_turn>|bos>|eos>|pad>|unk>)|\[(?=INST\]|/INST\]|SYSTEM_PROMPT\]|/SYSTEM_PROMPT\])")
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

PIECES = "key string, turn long, piece string, head int, body int, target boolean, system boolean, n long"
WINDOWS = "conv_id long, window long, formatted string, n_context int, n_tokens long, loss array<struct<begin: int, end: int>>"


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    """Drops the backslash behind each backslash or control string's first character."""
    return re.sub(r"([\\<\[])\\", r"\1", text)


def escape_role(role: str) -> str:
    """A role has no line feed: it is percent-encoded."""
    return escape(role.replace("%", "%25").replace("\n", "%0A"))


def unescape_role(role: str) -> str:
    return unescape(role).replace("%0A", "\n").replace("%25", "%")


def write_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn, and where its escaped text begins and how long it is."""
    head, body = f"{TURN}{escape_role(role)}\n", escape(text)
    return f"{head}{body}{END}\n", len(head), len(body)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    out = []
    for part in formatted.split(TURN)[1:]:
        role, _, body = part.partition("\n")
        if not body.endswith(f"{END}\n"):
            raise ValueError("a turn has no end")
        out.append((unescape_role(role), unescape(body[: -len(END) - 1])))
    return out


def counter(path: str) -> Callable[[str], int]:
    import base64

    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encoding = tiktoken.Encoding("chat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: len(encoding.encode_ordinary(text))


def _pieces(name: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(SparkFiles.get(name))
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                roles, texts = part.column(2).to_pylist(), part.column(3).to_pylist()
                done = [write_turn(r, t) for r, t in zip(roles, texts, strict=True)]
                columns = [
                    part.column(0), part.column(1), pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int32()), pa.array([d[2] for d in done], pa.int32()),
                    pa.array([r == "assistant" for r in roles]), pa.array([r == "system" for r in roles]), pa.array([count(d[0]) for d in done], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in PIECES.split(", ")])

    return run


def _assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("begin", pa.int32()), ("end", pa.int32())])
    for b in batches:
        for at in range(0, b.num_rows, 500):
            part = b.slice(at, 500)
            texts, context, tokens, loss = [], [], [], []
            for parts in part.column(2).to_pylist():
                place, spans = 0, []
                for p in parts:
                    if p["target"]:
                        spans.append({"begin": place + p["head"], "end": place + p["head"] + p["body"]})
                    place += len(p["piece"])
                texts.append("".join(p["piece"] for p in parts))
                context.append(sum(p["part"] < 2 for p in parts))
                tokens.append(sum(p["n"] for p in parts))
                loss.append(spans)
            keys = [int(k) if k else None for k in part.column(0).to_pylist()]
            columns = [pa.array(keys, pa.int64()), part.column(1), pa.array(texts, pa.string()), pa.array(context, pa.int32()), pa.array(tokens, pa.int64()), pa.array(loss, pa.list_(span))]
            yield pa.RecordBatch.from_arrays(columns, ["conv_id", "window", "formatted", "n_context", "n_tokens", "loss"])


def format_windows(
    conversations: DataFrame, tokenizer: str, stride: int = STRIDE, longest: int = LONGEST, history: int = HISTORY, history_turns: int = HISTORY_TURNS,
    conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """WINDOWS: a row for each window, with its loss mask as spans of the formatted text. tokenizer: a file of ranks that the driver can read."""
    conversations.sparkSession.sparkContext.addFile(tokenizer)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turns = conversations.select(text(conv_col).alias("key"), F.col(turn_col).cast("long").alias("turn"), text(role_col).alias("role"), text(text_col).alias("text"))
    turns = written(mapped(turns, _pieces(Path(tokenizer).name), PIECES), "pieces")
    some = F.col("turn").isNotNull()
    hashed = F.xxhash64("piece")
    turns = turns.withColumn("hash", F.when(some, 0).otherwise(hashed)).withColumn("block", F.struct(some.alias("some"), F.when(some, F.floor(F.col("turn") / BLOCK)).otherwise(F.floor(hashed / 2.0**64 * LOOSE)).alias("number")))
    local = Window.partitionBy("key", "block").orderBy("turn", "hash", "piece")
    turns = turns.withColumn("sum", F.sum("n").over(local.rowsBetween(Window.unboundedPreceding, 0))).withColumn("row", F.row_number().over(local))
    before = Window.partitionBy("key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = turns.groupBy("key", "block").agg(F.sum("n").alias("tokens"), F.count("*").alias("rows"))
    blocks = blocks.select("key", "block", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"before_{c}") for c in ("tokens", "rows")])
    placed = turns.join(blocks, ["key", "block"]).withColumns({"end": F.col("sum") + F.col("before_tokens"), "index": F.col("row") + F.col("before_rows")})
    placed = placed.withColumn("start", F.col("end") - F.col("n"))
    cell, last = F.floor(F.col("start") / stride), F.floor((F.col("end") - 1) / stride)
    placed = placed.withColumn("window", 2 * cell + F.when((cell == last) | (F.col("n") <= longest), 0).otherwise(1))
    placed = placed.select("key", "window", "index", "start", "piece", "head", "body", "target", "system", "n")

    part = lambda df, number: df.select("key", "window", F.struct(F.lit(number).alias("part"), "index", "piece", "head", "body", "target", "n").alias("p"))
    later = placed.groupBy("key", "window").agg(F.min("index").alias("first"), F.min("start").alias("begin")).filter("first > 1")
    seen = placed.withColumn("target", F.lit(False))
    system = seen.filter("index = 1 and system").drop("window")
    back = later.withColumn("index", F.explode(F.array(*[F.col("first") - k for k in range(1, history_turns + 1)])))
    back = back.join(seen.drop("window"), ["key", "index"]).filter((F.col("begin") - F.col("start") <= history) & ~(F.col("system") & (F.col("index") == 1)))
    parts = part(placed, 2).unionByName(part(back, 1)).unionByName(part(later.join(system, "key"), 0))
    windows = parts.groupBy("key", "window").agg(F.sort_array(F.collect_list("p")).alias("parts"))
    return mapped(windows, _assembled, WINDOWS)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, 500):
            part = b.slice(at, 500)
            count, own, loss, size = [], [], [], []
            for formatted, context, spans in zip(*(part.column(c).to_pylist() for c in ("formatted", "n_context", "loss")), strict=True):
                turns = read_turns(formatted)[context:]
                count.append(len(turns))
                own.append("".join(f"{r}\n{t}\n" for r, t in turns))
                loss.append("".join(unescape(formatted[s["begin"] : s["end"]]) for s in spans))
                size.append(len(formatted))
            columns = [part.column("conv_id"), part.column("window"), pa.array(count, pa.int64()), pa.array(own, pa.string()), pa.array(loss, pa.string()), pa.array(size, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["conv_id", "window", "n", "own", "loss", "size"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Running digests over windows that are sorted by conversation."""
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    now: list | None = None

    def closed(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)

    finish = lambda s: (s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5])
    for b in batches:
        rows = []
        for conv, n, own, loss, size in zip(*(b.column(c).to_pylist() for c in ("conv_id", "n", "own", "loss", "size")), strict=True):
            if now is None or now[0] != conv:
                if now is not None:
                    rows.append(finish(now))
                now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            now[1] += n
            now[2].update(own.encode())
            now[3] += len(loss)
            now[4].update(loss.encode())
            now[5] += size
        yield closed(rows)
    if now is not None:
        yield closed([finish(now)])


def digests(windows: DataFrame) -> DataFrame:
    """What a reader gets back from the windows, for each conversation."""
    read = mapped(windows.select("conv_id", "window", "formatted", "n_context", "loss"), _read, "conv_id long, window long, n long, own string, loss string, size long")
    ordered = read.repartition("conv_id").sortWithinPartitions("conv_id", "window")
    return mapped(ordered, _digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
