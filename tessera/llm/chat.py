"""Chat formatting by relational means only: collected turn structs are sorted,
adjacent turns of one role merged by array aggregation, and everything is
concatenated with Spark expressions.

Template, one block for each run of turns with the same role::

    <|start|>ROLE<|message|>TEXT<|turn|>TEXT<|end|>\\n

Every mark begins with ``<|``. Inside roles and texts ``<``, n backslashes and
``|`` become ``<``, n + 1 backslashes and ``|``: no text can then contain a mark,
all other text stays as it is, and taking the backslash away again restores it.

Defined cases: a null text or role is empty; turns are ordered by (turn, role,
text), null turn first, and repeated rows stay repeated turns; rows without
conv_id form one conversation with a null id; other columns are ignored; no rows
give no conversations. The result holds one string for each conversation, so a
conversation has to fit a row; nothing larger is ever gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = ["escape", "unescape", "format_chats", "read_turns", "read_loss"]

START, MESSAGE, TURN, END = "<|start|>", "<|message|>", "<|turn|>", "<|end|>\n"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\|", r"<\\$1|")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"<\\(\\*)\|", r"<$1|")


def format_chats(rows: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """``rows(conv_id, turn, role, text)`` -> one row per conversation: conv_id,
    ``formatted`` and ``loss_spans`` (code points [start, end) of the escaped
    texts of ``loss_roles``, the training mask)."""
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    g = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("t"))
    g = g.withColumn("starts", F.filter(F.sequence(F.lit(0), F.size("t") - 1),
                                        lambda i: (i == 0) | (F.col("t")[i]["role"] != F.col("t")[F.greatest(i - 1, F.lit(0))]["role"])))
    g = g.withColumn("blocks", F.transform("starts", lambda s, k: F.struct(
        F.col("t")[s]["role"].alias("role"),
        F.transform(F.slice("t", s + 1, F.coalesce(F.get("starts", k + 1), F.size("t")) - s), lambda x: escape(x["text"])).alias("texts"))))
    g = g.withColumn("blocks", F.transform("blocks", lambda b: F.struct(
        b["role"].isin(*loss_roles).alias("loss"), F.concat(F.lit(START), escape(b["role"]), F.lit(MESSAGE)).alias("head"), b["texts"].alias("texts"))))
    # One entry per turn: what precedes its text, the length of the text, whether it is learned.
    parts = F.flatten(F.transform("blocks", lambda b, k: F.transform(b["texts"], lambda x, i: F.struct(
        (F.when(i > 0, len(TURN)).otherwise(F.length(b["head"]) + F.when(k > 0, len(END)).otherwise(0))).alias("gap"),
        F.length(x).alias("len"), b["loss"].alias("loss")))))
    g = g.withColumn("parts", parts)
    span = "struct<start:bigint,end:bigint>"
    spans = F.aggregate("parts", F.struct(F.lit(0).cast("bigint").alias("pos"), F.array().cast(f"array<{span}>").alias("out")),
                        lambda a, x: F.struct(
                            (a["pos"] + x["gap"] + x["len"]).alias("pos"),
                            F.when(x["loss"], F.concat(a["out"], F.array(F.struct((a["pos"] + x["gap"]).alias("start"), (a["pos"] + x["gap"] + x["len"]).alias("end")))))
                            .otherwise(a["out"]).alias("out")),
                        lambda a: a["out"])
    text = F.array_join(F.transform("blocks", lambda b: F.concat(b["head"], F.array_join(b["texts"], TURN), F.lit(END))), "")
    return g.select("conv_id", text.alias("formatted"), spans.alias("loss_spans"))


def _literal(mark: str) -> str:
    return mark.replace("|", r"\|")


def read_turns(formatted: Column) -> Column:
    """The turns back from a formatted conversation: array of (role, text)."""
    blocks = F.filter(F.split(formatted, _literal(END)), lambda b: b != "")

    def turns(b: Column) -> Column:
        role = unescape(F.substring_index(b, MESSAGE, 1).substr(F.lit(len(START) + 1), F.length(b)))
        return F.transform(F.split(F.element_at(F.split(b, _literal(MESSAGE)), 2), _literal(TURN)),
                           lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(formatted.substr((s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")
