"""Chat formatting with Spark expressions only.

A conversation's turns are collected as structs and sorted; each turn is seen beside the one before it, so that
adjacent turns of one role fall into one message; the pieces are concatenated. Template of a message:

    <s>role NEWLINE text</s>        and <t> between the texts of merged turns

A control string inside a text or role gets one more backslash before its last character (`</s>` -> `</s\\>`,
`</s\\>` -> `</s\\\\>`), which is undone exactly when reading back; a new line in a role is written `<n>`.
"""

from pyspark.sql import functions as F

from unitgrid.llm import common

OPEN, CLOSE, NEXT, ROLE_LINE = "<s>", "</s>", "<t>", "<n>"
CONTROL = r"([<\[]/?(?:s|t|n|INST)\\*)([>\]])"
CONTROL_ESCAPED = r"([<\[]/?(?:s|t|n|INST)\\*)\\([>\]])"


def escaped(column):
    return F.regexp_replace(column, CONTROL, r"$1\\$2")


def unescaped(column):
    return F.regexp_replace(column, CONTROL_ESCAPED, "$1$2")


def formatted(conversations, conv="conv_id", turn="turn", role="role", text="text", trained=("assistant",)):
    """One row per conversation: its id, `formatted`, and `segments`, the same string as array<struct<text, loss>>.

    Segments with `loss` are the (escaped) texts of roles in `trained`, the loss mask. Turns are ordered by turn, then role,
    then text, so ties have one order; repeated rows are repeated turns; a null turn comes first. Null texts and roles
    are empty; rows with a null id are one conversation; an empty table gives an empty one. Columns other than the
    four named are not looked at. A conversation is one value, so it has to fit into one row.
    """
    q = common.quoted
    turns = conversations.select(
        q(conv).alias("conv"), q(turn).alias("turn"), F.regexp_replace(escaped(F.coalesce(q(role), F.lit(""))), "\n", ROLE_LINE).alias("role"),
        escaped(F.coalesce(q(text), F.lit(""))).alias("text"), F.coalesce(q(role).isin(*trained), F.lit(False)).alias("loss"))
    whole = turns.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", "loss"))).alias("turns"))
    # beside each turn the one before it; past the last turn there is only the one before
    none = F.lit(None).cast(whole.schema["turns"].dataType.elementType)

    def piece(now, before):
        opening = F.concat(F.lit(OPEN), now["role"], F.lit("\n"))
        join = (F.when(before.isNull(), opening).when(now.isNull(), F.lit(CLOSE))
                .when(now["role"] == before["role"], F.lit(NEXT)).otherwise(F.concat(F.lit(CLOSE), opening)))
        return F.array(F.struct(join.alias("text"), F.lit(False).alias("loss")),
                       F.struct(F.coalesce(now["text"], F.lit("")).alias("text"), F.coalesce(now["loss"], F.lit(False)).alias("loss")))

    pieces = whole.select("conv", F.flatten(F.zip_with("turns", F.concat(F.array(none), F.col("turns")), piece)).alias("segments"))
    return pieces.select(F.col("conv").alias(conv), F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments")


def read_back(column):
    """Turns of a formatted conversation, unescaped: array<struct<role, text>>."""
    messages = F.filter(F.split(column, CLOSE, -1), lambda m: m != "")

    def turns(message):
        head = F.regexp_replace(F.substring_index(message, "\n", 1), "^" + OPEN, "")
        body = F.substr(message, F.instr(message, F.lit("\n")) + 1)
        role = unescaped(F.regexp_replace(head, ROLE_LINE, "\n"))
        return F.transform(F.split(body, NEXT, -1), lambda t: F.struct(role.alias("role"), unescaped(t).alias("text")))

    return F.flatten(F.transform(messages, turns))


def loss_text(column):
    """All text under the loss mask, unescaped piece by piece."""
    return F.array_join(F.transform(F.filter(column, lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")
