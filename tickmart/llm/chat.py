"""Chat formatting with typed content parts, in DataFrame functions only.

A turn is written as ``<turn>role\\ncontent</turn>\\n``. Inside roles and texts a backslash becomes ``\\b``, ``<``
becomes ``\\l`` and, in roles, a line break ``\\e``; so every ``<`` of the output is a control string and texts come
back exactly. Images, audio and documents become placeholders such as ``<image 2>``, numbered through the
conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<turn>", "</turn>\n"
MEDIA = ("image", "audio", "document")
#: Tokens that one unit of a part expands to: an image's tiles, seconds of audio, pages of a document.
TOKENS_PER_UNIT = {"image": 256, "audio": 25, "document": 512}
WORD = r"[^\x20\x09-\x0D]+"

PARTS = "array<struct<kind:string,text:string,ref:string,units:bigint>>"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def _role_out(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\e"))


def _role_in(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("\\e"), F.lit("\n")))


def text_part(text: Column) -> Column:
    """A turn's parts when it has nothing but a text."""
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), F.lit(None).cast("string").alias("ref"),
                            F.lit(None).cast("bigint").alias("units")))


def _is_media(part: Column) -> Column:
    return F.coalesce(part["kind"].isin(*MEDIA), F.lit(False))


def _visit(part: Column, number: Column) -> Column:
    """What one part becomes: its text in the output, its tokens, its attachment."""
    units = F.greatest(F.coalesce(part["units"], F.lit(1)), F.lit(0))
    rate = F.element_at(F.create_map(*[F.lit(x) for kv in TOKENS_PER_UNIT.items() for x in kv]), part["kind"])
    plain = F.coalesce(part["text"], F.lit(""))
    media = _is_media(part)
    tokens = F.when(media, units * rate).otherwise(F.regexp_count(plain, F.lit(WORD))).cast("bigint")
    shown = F.when(media, F.concat(F.lit("<"), part["kind"], F.lit(" "), number.cast("string"), F.lit(">"))).otherwise(escaped(plain))
    attachment = F.when(media, F.struct(number.cast("int").alias("number"), part["kind"].alias("kind"), part["ref"].alias("ref"),
                                        tokens.alias("tokens")))
    return F.struct(shown.alias("shown"), tokens.alias("tokens"), attachment.alias("attachment"))


def flattened(turns: DataFrame) -> DataFrame:
    """Turns in order, with ``place, content, tokens, attachments``: parts visited in the order they stand."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", F.col("parts").cast("string"))
    ahead = order.rowsBetween(Window.unboundedPreceding, -1)
    parts = F.filter(F.coalesce("parts", F.array().cast(PARTS)), lambda p: p.isNotNull())
    media = lambda ps: F.size(F.filter(ps, _is_media))
    placed = (turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), parts.alias("parts"))
              .withColumn("place", F.row_number().over(order))
              .withColumn("first", F.coalesce(F.sum(media(F.col("parts"))).over(ahead), F.lit(0))))
    visited = F.transform("parts", lambda p, i: _visit(p, F.col("first") + F.when(
        _is_media(p), media(F.slice("parts", 1, i + 1))).otherwise(0)))
    return placed.withColumn("visited", visited).select(
        "conv_id", "place", "role",
        F.array_join(F.transform("visited", lambda v: v["shown"]), "").alias("content"),
        F.aggregate("visited", F.lit(0).cast("bigint"), lambda a, v: a + v["tokens"]).alias("tokens"),
        F.filter(F.transform("visited", lambda v: v["attachment"]), lambda a: a.isNotNull()).alias("attachments"))


def formatted(turns: DataFrame, learned: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id, formatted, loss, attachments, tokens``.

    ``turns`` has ``conv_id, turn, role`` and ``parts``, an array of ``(kind, text, ref, units)``. ``loss`` lists start
    and length, in code points of ``formatted``, of each ``learned`` turn's content. Image, audio and document parts
    become numbered placeholders; ``attachments`` records number, kind, ref and expanded tokens (no units count as
    one), ``tokens`` counts words and expanded parts. Parts of any other kind count as text. Null roles, texts and
    part lists are empty, null parts are skipped, a null conv_id is a conversation of its own, and turns with equal
    numbers stand in order of role and parts. Repeated rows stay repeated. Other columns are ignored. An empty table
    gives an empty result.

    Each conversation ends as one string, so its turns meet in one task; starts come from a running sum there.
    """
    role = _role_out(F.col("role"))
    piece = F.concat(F.lit(OPEN), role, F.lit("\n"), "content", F.lit(CLOSE))
    ahead = Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    sized = flattened(turns).withColumn("piece", piece).withColumn(
        "start", F.coalesce(F.sum(F.length("piece")).over(ahead), F.lit(0)) + len(OPEN) + F.length(role) + 1)
    one = F.struct("place", "piece", "start", F.length("content").alias("length"), (F.col("role") == learned).alias("learned"),
                   "tokens", "attachments")
    return sized.groupBy("conv_id").agg(F.array_sort(F.collect_list(one)).alias("turns")).select(
        "conv_id", F.array_join(F.col("turns.piece"), "").alias("formatted"),
        F.transform(F.filter("turns", lambda t: t["learned"]), lambda t: F.struct(
            t["start"].cast("bigint").alias("start"), t["length"].cast("bigint").alias("length"))).alias("loss"),
        F.flatten("turns.attachments").alias("attachments"),
        F.aggregate("turns.tokens", F.lit(0).cast("bigint"), lambda a, t: a + t).alias("tokens"))


def parsed(chats: DataFrame) -> DataFrame:
    """Formatted conversations read back: ``conv_id, turns, learned``.

    ``turns`` has role and text as they were, placeholders of attachments included; ``learned`` is the text under the
    loss mask, joined in order.
    """
    piece = F.split("formatted", OPEN)
    turn = lambda p: F.struct(
        _role_in(F.substring_index(p, "\n", 1)).alias("role"),
        unescaped(F.substring(p, F.length(F.substring_index(p, "\n", 1)) + 2,
                              F.length(p) - F.length(F.substring_index(p, "\n", 1)) - 1 - len(CLOSE))).alias("text"))
    under = lambda s: unescaped(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int")))
    return chats.select("*", F.transform(F.slice(piece, 2, F.size(piece)), turn).alias("turns"),
                        F.array_join(F.transform("loss", under), "").alias("learned"))


def digests(chats: DataFrame) -> DataFrame:
    """Per conversation the digest row that lets a run be compared with its source."""
    line = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    return parsed(chats).select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", line), ""), 256).alias("turns_sha256"),
        F.length("learned").cast("bigint").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"))
