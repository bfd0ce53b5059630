"""Chat formatting: turns to text segments with a loss flag, from a declarative template.

A finite-state machine over roles checks the order of turns: its state is the role
before. Formatting works turn by turn; a long conversation is split by ranges of
its turn numbers, and each range takes its first state from the last role of the
range before.

Control strings inside texts are made harmless reversibly: a backslash is put
after the ``<`` of every ``<|``, ``<\\|``, ``<\\\\|`` and so on.

Defined cases: a null text or role is empty; an unknown role is formatted and
marked illegal; turns of one number are ordered by role and text; null turns come
first; a null ``conv_id`` is a conversation of its own; repeated rows are turns
each; extra columns are left out; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablekit.llm.shipping import ship

#: Turns of one conversation handled together.
RANGE_TURNS = 512


@dataclass(frozen=True)
class Template:
    """Marks around a turn, the roles to learn, and the roles that may follow each state."""

    before_role: str = "<|im_start|>"
    after_role: str = "\n"
    closing: str = "<|im_end|>\n"
    learned: tuple[str, ...] = ("assistant",)
    order: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user", "tool"),
            "tool": ("assistant",),
        }
    )


CHATML = Template()


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def escaped_role(role: Column) -> Column:
    """As :func:`escaped`, with a newline as ``<n|``."""
    return F.replace(F.regexp_replace(role, r"<(\\*n?)\|", r"<\\$1|"), F.lit("\n"), F.lit("<n|"))


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text) if "<\\" in text else text


def unescape_role(role: str) -> str:
    return re.sub(r"<\\(\\*n?)\|", r"<\1|", role.replace("<n|", "\n"))


def format_chat(conversations: DataFrame, template: Template = CHATML, range_turns: int = RANGE_TURNS) -> DataFrame:
    """A row per turn: ``conv_id``, ``turn``, ``role``, ``legal`` and ``segments`` (``text``, ``loss``)."""
    turns = conversations.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("span", F.floor(F.col("turn") / range_turns))
    by_span = Window.partitionBy("conv_id").orderBy("span")
    last = F.max(F.struct("turn", "role"))["role"]
    spans = (
        turns.groupBy("conv_id", "span")
        .agg(last.alias("last_role"))
        .select(
            F.col("conv_id").alias("span_conv"),
            F.col("span").alias("its_span"),
            F.lag("last_role", 1, "").over(by_span).alias("role_before"),
        )
    )
    in_span = Window.partitionBy("conv_id", "span").orderBy("turn", "role")
    joined = turns.join(
        spans, F.col("conv_id").eqNullSafe(F.col("span_conv")) & F.col("span").eqNullSafe(F.col("its_span"))
    )
    state = F.coalesce(F.lag("role").over(in_span), F.col("role_before"))
    legal = F.lit(False)
    for before, roles in template.order.items():
        legal = F.when(F.col("state") == before, F.col("role").isin(*roles)).otherwise(legal)
    segment = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    opening = F.concat(F.lit(template.before_role), escaped_role(F.col("role")), F.lit(template.after_role))
    return joined.withColumn("state", state).select(
        "conv_id",
        "turn",
        "role",
        legal.alias("legal"),
        F.array(
            segment(opening, F.lit(False)),
            segment(escaped(F.col("text")), F.col("role").isin(*template.learned)),
            segment(F.lit(template.closing), F.lit(False)),
        ).alias("segments"),
    )


def conversation_digests(formatted: DataFrame, template: Template = CHATML) -> DataFrame:
    """Per conversation, what its formatted text gives when read back.

    A digest over all turns is a sum over one stream, so a conversation's turns
    pass through one task in order; batch by batch, never all in memory.
    """
    ship(formatted.sparkSession)
    id_type = formatted.schema["conv_id"].dataType.simpleString()
    rows = (
        formatted.select(
            "conv_id",
            "turn",
            "role",
            "legal",
            F.col("segments")["text"].alias("texts"),
            F.col("segments")["loss"].alias("losses"),
        )
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", F.col("texts")[1])
    )
    pattern = re.compile(
        re.escape(template.before_role) + "(.*?)" + re.escape(template.after_role) + "(.*)" + re.escape(template.closing),
        re.DOTALL,
    )
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "legal"]

    def read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, done = None, []

        def finished():
            conv, n, turns, chars, loss, size, legal = current
            return conv, n, turns.hexdigest(), chars, loss.hexdigest(), size, legal

        def as_batch():
            columns = list(zip(*done, strict=True))
            kinds = [ids.type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            ids = batch.column("conv_id")
            for conv, texts, losses, legal in zip(
                ids.to_pylist(),
                batch.column("texts").to_pylist(),
                batch.column("losses").to_pylist(),
                batch.column("legal").to_pylist(),
                strict=True,
            ):
                if current is None or current[0] != conv:
                    if current is not None:
                        done.append(finished())
                    current = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, True]
                whole = "".join(texts)
                role, body = pattern.fullmatch(whole).groups()
                current[1] += 1
                current[2].update(f"{unescape_role(role)}\n{unescape(body)}\n".encode())
                learned = unescape("".join(t for t, loss in zip(texts, losses, strict=True) if loss))
                current[3] += len(learned)
                current[4].update(learned.encode())
                current[5] += len(whole)
                current[6] &= legal
            if len(done) >= 1000:
                yield as_batch()
                done = []
        if current is not None:
            done.append(finished())
            yield as_batch()

    return rows.mapInArrow(
        read_back,
        f"conv_id {id_type}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,"
        " formatted_chars long, legal boolean",
    )
