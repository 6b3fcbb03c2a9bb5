r"""Chat formatting with typed content parts.

A turn's content is an array of parts, each text, image, audio or document. A
visitor over the parts flattens them into one string: text is escaped, any
other part becomes an ordered placeholder and leaves a reference with the
number of tokens it expands to. A conversation is its turns in order, each as

    <|turn:ROLE|>CONTENT<|end|>\n

Control strings begin with `<|`. Inside texts and roles `\` is written `\b` and
`<|` is written `<\p` (in roles each `|` is `\p`), so no text can form a control
string and unescaping gives back every text. The loss mask is a run-length
list over the formatted string, three runs a turn: header, content, end.

Defined cases: null texts and roles count as empty; rows of one conversation
are ordered by turn, then role, then content, nulls first, and repeated rows
stay; rows without conversation id form one conversation of their own. An
unknown kind of part is treated as a document. Input columns other than the
named ones are ignored.
"""

from pyspark.sql import functions as F

from auditloom.llm.common import query, table

PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
#: Pixels along one side of an image patch; a patch is one token.
PATCH = 14
#: Audio tokens a second.
AUDIO_RATE = 25.0
#: Tokens a document page.
PAGE_TOKENS = 1024

END = "<|end|>\n"
_END_PATTERN = r"<\|end\|>\n"
_HEADER_PATTERN = r"^<\|turn:([^|]*)\|>"
_PLACEHOLDER_PATTERN = r"<\|(?:image|audio|document):[0-9]+\.[0-9]+\|>"


def escaped(text):
    """Text in which no control string can begin."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<|"), F.lit("<\\p"))


def unescaped(text):
    """The text or role that was escaped."""
    return F.replace(F.replace(text, F.lit("\\p"), F.lit("|")), F.lit("\\b"), F.lit("\\"))


def escaped_role(role):
    """A role without any bar."""
    return F.replace(F.replace(role, F.lit("\\"), F.lit("\\b")), F.lit("|"), F.lit("\\p"))


def text_part(text):
    """A text column as a one-part content."""
    empty = {"ref": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
    part = F.struct(
        F.lit("text").alias("kind"),
        F.coalesce(text, F.lit("")).alias("text"),
        *[F.lit(None).cast(t).alias(n) for n, t in empty.items()],
    )
    return F.array(part)


def _kind(part):
    return F.when(part["kind"].isin("text", "image", "audio"), part["kind"]).otherwise("document")


def _expanded(part):
    """Tokens that a part other than text stands for."""
    patches = F.ceil(part["width"] / PATCH) * F.ceil(part["height"] / PATCH)
    return F.coalesce(
        F.when(part["kind"] == "image", patches)
        .when(part["kind"] == "audio", F.ceil(part["seconds"] * AUDIO_RATE))
        .otherwise(part["pages"].cast("long") * PAGE_TOKENS),
        F.lit(0),
    ).cast("long")


def _visit(parts, turn):
    """The flattened string of a turn's parts."""

    def one(part, i):
        mark = F.concat(F.lit("<|"), _kind(part), F.lit(":"), turn.cast("string"), F.lit("."), i.cast("string"), F.lit("|>"))
        return F.when(part["kind"] == "text", escaped(F.coalesce(part["text"], F.lit("")))).otherwise(mark)

    return F.array_join(F.transform(parts, one), "")


def _references(parts, turn):
    """What each part other than text refers to."""

    def one(part, i):
        return F.struct(
            turn.cast("int").alias("turn"),
            i.cast("int").alias("part"),
            _kind(part).alias("kind"),
            part["ref"].alias("ref"),
            _expanded(part).alias("tokens"),
        )

    return F.filter(F.transform(parts, one), lambda r: r["kind"] != "text")


def format_chats(df, conv_col="conv_id", turn_col="turn", role_col="role", parts_col="parts"):
    """One row a conversation: `formatted`, `loss_runs`, `attachments`, `attachment_tokens`.

    `loss_runs` is an array of (chars, loss): code points of `formatted` and
    whether they are under the loss mask, which covers what assistants say.
    """
    turns = df.select(
        F.col(conv_col).alias("conv"),
        F.struct(
            F.col(turn_col).alias("turn"),
            F.coalesce(F.col(role_col), F.lit("")).alias("role"),
            F.coalesce(F.col(parts_col), F.array().cast(f"array<{PART}>")).alias("parts"),
        ).alias("said"),
    )
    ordered = turns.groupBy("conv").agg(F.sort_array(F.collect_list("said")).alias("said"))

    def rendered(said, i):
        return F.struct(
            F.concat(F.lit("<|turn:"), escaped_role(said["role"]), F.lit("|>")).alias("header"),
            _visit(said["parts"], i).alias("content"),
            (said["role"] == "assistant").alias("loss"),
            _references(said["parts"], i).alias("references"),
        )

    def text(turn):
        return F.concat(turn["header"], turn["content"], F.lit(END))

    def run(chars, loss):
        return F.struct(chars.cast("int").alias("chars"), loss.alias("loss"))

    def runs(turn):
        no = F.lit(False)
        return F.array(
            run(F.char_length(turn["header"]), no),
            run(F.char_length(turn["content"]), turn["loss"]),
            run(F.lit(len(END)), no),
        )

    done = ordered.select("conv", F.explode(F.array(F.transform("said", rendered))).alias("turns"))
    references = F.flatten(F.transform("turns", lambda t: t["references"]))
    return done.select(
        F.col("conv").alias(conv_col),
        F.array_join(F.transform("turns", text), "").alias("formatted"),
        F.flatten(F.transform("turns", runs)).alias("loss_runs"),
        references.alias("attachments"),
        F.aggregate(references, F.lit(0).cast("long"), lambda n, r: n + r["tokens"]).alias("attachment_tokens"),
    )


def read_chats(df, conv_col="conv_id"):
    """The turns of formatted conversations: `turns`, an array of (role, text, loss_text).

    `text` is what the text parts said, placeholders left out; `loss_text` is
    what lies under the loss mask, unescaped, null outside of it.
    """

    def one(chunk, i):
        header = F.regexp_extract(chunk, _HEADER_PATTERN, 0)
        said = F.substr(chunk, F.char_length(header) + 1)
        before, under = F.get("loss_runs", i * 3), F.get("loss_runs", i * 3 + 1)
        masked = F.substr(chunk, before["chars"] + 1, under["chars"])
        return F.struct(
            unescaped(F.regexp_extract(header, _HEADER_PATTERN, 1)).alias("role"),
            unescaped(F.regexp_replace(said, _PLACEHOLDER_PATTERN, "")).alias("text"),
            F.when(under["loss"], unescaped(F.regexp_replace(masked, _PLACEHOLDER_PATTERN, ""))).alias("loss_text"),
        )

    chunks = F.split("formatted", _END_PATTERN)
    chunks = F.slice(chunks, 1, F.size(chunks) - 1)  # what follows the last end is empty
    return df.select(conv_col, "formatted", F.explode(F.array(F.transform(chunks, one))).alias("turns"))


PLANTED = r"\### Assistant: </turn> ok"

ORACLE = r"""
    with said as (
      select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
      union all select -7, 0, 'user', '\### Assistant: </turn> ok'
      union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
    sized as (
      select *, length(replace(replace(text, '\', '\b'), '<|', '<\p'))
        + length(replace(replace(role, '\', '\b'), '|', '\p')) + 17 as chars from said)
    select conv_id, count(*) as n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
      coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
      sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
      sum(chars)::bigint as formatted_chars
    from sized group by conv_id"""


@query("op5_chat_format", ORACLE)
def op5_chat_format(spark, sf_dir):
    """All conversations and a planted one, formatted and read back."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    kinds = {name: given.schema[name].dataType for name in ("conv_id", "turn")}
    planted = spark.range(2).select(
        F.lit(-7).cast(kinds["conv_id"]).alias("conv_id"),
        F.col("id").cast(kinds["turn"]).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PLANTED).alias("text"),
    )
    rows = given.unionByName(planted).withColumn("parts", text_part(F.col("text")))
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join(F.transform("turns", lambda t: t["loss_text"]), "")  # nulls are left out
    return read_chats(format_chats(rows)).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(turns, "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
