"""Chat formatting by token-level assembly.

Template: ``<s>`` opens a conversation; each turn is
``[INST]`` role ``[/INST]`` text ``</s>``.  The four control strings are
reserved ids behind the vocabulary.  Roles and texts are encoded separately as
plain text, and the reserved ids are spliced between them, so no content can
ever become a control id.  In the rendered form a control string inside
content is escaped: a backslash after its first character, and backslashes are
doubled; undoing both is exact.

Places in a conversation's id stream come from prefix sums of segment lengths:
rows are range-partitioned in turn order, each slice keeps a running total, and
a conversation that goes on in later slices adds the totals of the slices
before.  The loss mask of a turn is the range of its text's ids if the role is
trained.

Defined results: a null text is an empty one, a null role an empty role.  Rows
come in order of (turn, role, text), nulls first, repeats included.  A null
conversation id is a conversation of its own.  Empty tables give no rows.

Scale: slices cut a conversation of any length, so a hot one is encoded, and
decoded when it is read, by many tasks.  Only the digests over a whole
conversation, sequential by nature, run in one task for each conversation: it
gets runs of turns joined to about ``RUN_CHARS`` characters and streams them.
Totals are one row for each (slice, conversation).  Output rows are turns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeline.llm.common import written

BEGIN, TURN, SAYS, END = "<s>", "[INST]", "[/INST]", "</s>"
CONTROL = (BEGIN, TURN, SAYS, END)
ESCAPED = (*CONTROL, "<|endoftext|>")   # never left whole inside content
TRAINED = ("assistant",)
RUN_CHARS = 1 << 20   # characters of turns that are digested as one run
_CONTROL = re.compile("|".join(map(re.escape, ESCAPED)))


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    """Doubled backslashes become one, single ones were put in and go."""
    return re.sub(r"\\(\\?)", r"\1", text)


@cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True  # their strings in content are plain text
    return t, t.get_vocab_size(with_added_tokens=True)


def reserved(path: str) -> dict[str, int]:
    """Control string -> its id behind the vocabulary."""
    size = _tokenizer(path)[1]
    return {c: size + k for k, c in enumerate(CONTROL)}


_TURNS = "slice int, conv long, turn long, start long, ids array<int>, loss_from long, loss_to long"


def format_chat(rows: DataFrame, tokenizer_path: str, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                trained: tuple[str, ...] = TRAINED) -> DataFrame:
    """One row a turn:

    conv, turn; opens: the conversation's first; start: place of its first id
    in the conversation; ids; loss_from / loss_to: its range under the loss
    mask (places in the conversation; equal if nothing is trained)."""
    order = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "role", "text")]
    source = rows.select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).cast("string").alias("role"),
                         F.col(text_col).cast("string").alias("text"))
    sliced = source.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("slice", F.spark_partition_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, _ = _tokenizer(tokenizer_path)
        mark = reserved(tokenizer_path)
        last, place, any_row = None, 0, False
        for whole in batches:
            for lo in range(0, whole.num_rows, 1024):
                b = whole.slice(lo, 1024)
                conv, roles = b.column("conv").to_pylist(), b.column("role").fill_null("").to_pylist()
                texts = b.column("text").fill_null("").to_pylist()
                parts = tokenizer.encode_batch_fast([escape(x) for x in roles + texts], add_special_tokens=False)
                says, spoken = parts[: len(roles)], parts[len(roles):]
                heads = [not any_row and k == 0 or c != (conv[k - 1] if k else last) for k, c in enumerate(conv)]
                ids = [[mark[TURN], *r.ids, mark[SAYS], *t.ids, mark[END]] for r, t in zip(says, spoken, strict=True)]
                # Prefix sums of segment lengths, begun anew at each conversation.
                size = np.array([len(x) for x in ids], np.int64)
                total = place + np.cumsum(size)
                base = np.where(heads, total - size, 0)
                start = total - size - np.maximum.accumulate(base)
                text_to = start + size - 1
                trains = np.array([r in trained for r in roles])
                text_from = np.where(trains, text_to - np.array([len(t.ids) for t in spoken], np.int64), text_to)
                place, last, any_row = int(start[-1] + size[-1]), conv[-1], True
                yield pa.RecordBatch.from_arrays([b.column("slice"), b.column("conv"), b.column("turn"), pa.array(start), pa.array(ids, pa.list_(pa.int32())),
                                                  pa.array(text_from), pa.array(text_to)], ["slice", "conv", "turn", "start", "ids", "loss_from", "loss_to"])

    turns = written(sliced.mapInArrow(run, _TURNS), "turns")
    earlier = Window.partitionBy("conv").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    # Of each slice only its first conversation can have begun before it.
    more = turns.groupBy("conv", "slice").agg(F.max(F.col("loss_to") + 1).alias("total")) \
        .select(F.col("slice").alias("_slice"), F.col("conv").alias("_conv"), F.sum("total").over(earlier).alias("before")).where("before is not null")
    more = written(more, "continued")
    before, opens = F.coalesce("before", F.lit(0)), F.col("before").isNull() & (F.col("start") == 0)
    begin = F.array(F.lit(reserved(tokenizer_path)[BEGIN]).cast("int"))
    return turns.join(more, (F.col("slice") == F.col("_slice")) & F.col("conv").eqNullSafe(F.col("_conv")), "left").select(
        "conv", "turn", opens.alias("opens"), F.when(opens, 0).otherwise(before + F.col("start") + 1).cast("long").alias("start"),
        F.when(opens, F.concat(begin, "ids")).otherwise(F.col("ids")).alias("ids"),
        (before + F.col("loss_from") + 1).alias("loss_from"), (before + F.col("loss_to") + 1).alias("loss_to"))


_RUN = pa.schema([("conv", pa.int64()), ("start", pa.int64()), ("n", pa.int64()), ("turns", pa.large_string()), ("loss", pa.large_string()), ("chars", pa.int64())])
_READ = pa.schema([("conv", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()),
                   ("formatted_chars", pa.int64())])


def _plain_runs(formatted: DataFrame, tokenizer_path: str) -> DataFrame:
    """Turns decoded where they lie; neighbours of one conversation are joined."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, size = _tokenizer(tokenizer_path)
        says = size + CONTROL.index(SAYS)
        now: dict | None = None

        def out(d: dict) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{**d, "turns": "".join(d["turns"]), "loss": "".join(d["loss"])}], _RUN)

        for whole in batches:
            for lo in range(0, whole.num_rows, 1024):
                b, cut = whole.slice(lo, 1024).to_pylist(), []
                for r in b:
                    ids, begin, end = r["ids"], 1 if r["opens"] else 0, len(r["ids"]) - 1
                    middle = ids.index(says)
                    cut += [ids[begin + 1: middle], ids[middle + 1: end], ids[r["loss_from"] - r["start"]: r["loss_to"] - r["start"]]]
                flat = tokenizer.decode_batch(cut, skip_special_tokens=False)
                for k, r in enumerate(b):
                    role, text, loss = flat[3 * k: 3 * k + 3]
                    if now is None or now["chars"] >= RUN_CHARS or r["conv"] != now["conv"] or r["start"] != now["next"]:
                        if now:
                            yield out(now)
                        now = {"conv": r["conv"], "start": r["start"], "n": 0, "turns": [], "loss": [], "chars": 0}
                    now["n"] += 1
                    now["next"] = r["start"] + len(r["ids"])
                    now["turns"].append(f"{unescape(role)}\n{unescape(text)}\n")
                    now["loss"].append(unescape(loss))
                    now["chars"] += (len(BEGIN) if r["opens"] else 0) + len(TURN + SAYS + END) + len(role) + len(text)
        if now:
            yield out(now)

    return formatted.select("conv", "opens", "start", "ids", "loss_from", "loss_to") \
        .mapInArrow(run, "conv long, start long, n long, turns string, loss string, chars long")


def read_chat(formatted: DataFrame, tokenizer_path: str) -> DataFrame:
    """Per conversation, from the ids alone: (conv, n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: dict | None = None

        def out(done: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"conv": d["conv"], "n_turns": d["n"], "turns_sha256": d["turns"].hexdigest(), "loss_chars": d["loss_chars"],
                                                "loss_sha256": d["loss"].hexdigest(), "formatted_chars": d["chars"]} for d in done], _READ)

        for b in batches:
            done = []
            for conv, n, turns, loss, chars in zip(*[b.column(c) for c in ("conv", "n", "turns", "loss", "chars")], strict=True):
                if now is None or conv.as_py() != now["conv"]:
                    done += [now] if now else []
                    now = {"conv": conv.as_py(), "n": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256(), "loss_chars": 0, "chars": 0}
                now["n"] += n.as_py()
                now["chars"] += chars.as_py()
                now["turns"].update(turns.as_py().encode())
                said = loss.as_py()
                now["loss_chars"] += len(said)
                now["loss"].update(said.encode())
            if done:
                yield out(done)
        if now:
            yield out([now])

    return _plain_runs(formatted, tokenizer_path).repartition(F.col("conv")).sortWithinPartitions(F.col("conv").asc_nulls_first(), "start") \
        .mapInArrow(run, "conv long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
