r"""Chat formatting by schema fingerprints.

A record is one JSON text. Its fingerprint is the hash of its nested field paths, which
``schema_of_variant`` gives in sorted order. Fingerprints select a declarative mapping
(``MAPPINGS``); the mapping says where the turns are and how their roles are spelled,
and everything comes out as canonical turns, role and text. A fingerprint that isn't known is
matched by its required paths: the first of ``LOOSE`` whose fields are there is taken, whatever
other fields a record or its messages have; a ``system`` text beside them is the first turn.

The template is ``<|im_start|>role\ntext<|im_end|>\n`` for each turn. Inside a role or
text each ``<``, any number of ``\`` and ``|`` gets one more ``\`` before the ``|``, so
that no control string is left, and taking one away restores the text. Before that, a
role's ``\`` is doubled and its line breaks are written ``\`` and ``n``.

The loss mask of a formatted conversation is a list of spans (code points, end
exclusive), one for each assistant turn: its escaped text, without role or end mark.

All of it is DataFrame code. Defined results:

* a record that isn't JSON or has the required paths of no mapping has null turns (``unknown``
  counts these by fingerprint); one whose array of turns is empty has no turns
* a message's content may be a list of parts: their texts are joined; parts without text are
  left out
* of a prompt with a chosen and a rejected answer the chosen one counts; a record of a text
  alone is one turn of the assistant, all of which is learned from
* a null role or text is the empty one; turns of a record keep their order
* a conversation without turns is formatted as the empty text
* rows of one turn number come in the order of role and text; those without a number first
* ``digest`` makes a record for each turn (or pair of turns), and several for a long text,
  as what parses JSON has limits of size; a record that doesn't parse is an error there
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilspan.functions.text import let, scan

START, END = "<|im_start|>", "<|im_end|>"
MASK = "array<struct<start:int,end:int>>"


@dataclass(frozen=True)
class Mapping:
    """path: of the array of turns, with the names of their fields; or fields: a turn for each (role, paths), what its paths give being joined by a blank line. A layout may come with any of the optional fields, which don't count."""

    name: str
    paths: tuple[str, ...]
    path: str = ""
    role: str = ""
    text: str = ""
    fields: tuple[tuple[str, tuple[str, ...]], ...] = ()
    optional: tuple[str, ...] = ("id", "source")


def _pair(name: str, ask: str, reply: str) -> Mapping:
    return Mapping(name, (ask, reply), fields=(("user", (f"$.{ask}",)), ("assistant", (f"$.{reply}",))))


#: The layouts that are known, by their field paths.
MAPPINGS = (
    Mapping("messages", ("messages[].content", "messages[].role"), "$.messages", "role", "content", optional=("id", "source", "messages[].id", "messages[].name")),
    Mapping("messages", ("messages[]",), "$.messages", "role", "content"),
    Mapping("conversations", ("conversations[].from", "conversations[].value"), "$.conversations", "from", "value", optional=("id", "source", "conversations[].id", "conversations[].name")),
    Mapping("conversations", ("conversations[]",), "$.conversations", "from", "value"),
    _pair("prompt_response", "prompt", "response"),
    _pair("prompt_completion", "prompt", "completion"),
    _pair("instruction_output", "instruction", "output"),
    Mapping("instruction_input_output", ("input", "instruction", "output"), fields=(("user", ("$.instruction", "$.input")), ("assistant", ("$.output",)))),
    Mapping("system_prompt_response", ("prompt", "response", "system"), fields=(("system", ("$.system",)), ("user", ("$.prompt",)), ("assistant", ("$.response",)))),
)


@dataclass(frozen=True)
class Loose:
    """Required paths only. lists: arrays of messages, one after the other; or fields, as in ``Mapping``, the first path of each role being required."""

    name: str
    lists: tuple[str, ...] = ()
    fields: tuple[tuple[str, tuple[str, ...]], ...] = ()


def _asks(name: str, ask: tuple[str, ...], reply: str) -> Loose:
    return Loose(name, fields=(("user", tuple(f"$.{a}" for a in ask)), ("assistant", (f"$.{reply}",))))


#: Layouts by their required paths; the first that fits counts.
LOOSE = (
    Loose("messages", lists=("$.messages",)),
    Loose("conversations", lists=("$.conversations",)),
    Loose("prompt_completion", lists=("$.prompt", "$.completion")),
    Loose("prompt_chosen", lists=("$.prompt", "$.chosen")),
    _asks("instruction_output", ("instruction", "input"), "output"),
    _asks("prompt_response", ("prompt",), "response"),
    _asks("prompt_completion", ("prompt",), "completion"),
    _asks("prompt_chosen", ("prompt",), "chosen"),
    Loose("text", fields=(("assistant", ("$.text",)),)),
)
#: Names of a message's fields.
ROLE_FIELDS, TEXT_FIELDS = ("role", "from"), ("content", "value")
#: Other spellings of roles.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
#: Layouts that ``records_of`` gives a pair of turns.
PAIRS = (("prompt", "response"), ("prompt", "completion"), ("instruction", "output"))
#: Most characters of one text in a record that ``records_of`` makes: try_parse_json gives NULL beyond 20 million in a string or 128 MB in all.
PIECE = 2_000_000


def field_paths(variant: Column) -> Column:
    """Sorted nested field paths of a variant, comma-joined: the fields' types don't count."""
    schema = F.schema_of_variant(variant)
    plain = F.regexp_replace(schema, r"(STRING|BIGINT|BOOLEAN|DOUBLE|FLOAT|VOID|DECIMAL\(\d+,\s*\d+\)|DATE|TIMESTAMP(_NTZ)?|BINARY)", "-")
    return plain


def _shape(paths: tuple[str, ...]) -> str:
    """The same text as ``field_paths`` for a record with these paths; a path that ends in ``[]`` is an array without elements."""
    top: dict[str, list[str]] = {}
    empty = {p[:-2] for p in paths if p.endswith("[]")}
    for p in paths:
        head, _, rest = p.removesuffix("[]").partition("[].")
        top.setdefault(head, [])
        if rest:
            top[head].append(rest)
    cells = []
    for head in sorted(top):
        inner = ", ".join(f"{x}: -" for x in sorted(top[head]))
        cells.append(f"{head}: ARRAY<OBJECT<{inner}>>" if inner else f"{head}: ARRAY<->" if head in empty else f"{head}: -")
    return f"OBJECT<{', '.join(cells)}>"


def shapes() -> dict[str, str]:
    """The layout of each shape that is known: with each choice of optional fields."""
    return {_shape((*m.paths, *more)): m.name for m in MAPPINGS for n in range(len(m.optional) + 1) for more in combinations(m.optional, n)}


def fingerprint(variant: Column) -> Column:
    return F.sha2(field_paths(variant), 256)


def _renamed(m: Mapping) -> Callable[[Column], Column]:
    return lambda t: F.struct(t[m.role].alias("role"), t[m.text].alias("text"))


def _joined(texts: list[Column]) -> Column:
    """The texts that aren't null or empty with blank lines between them; of one text, that text."""
    return texts[0] if len(texts) == 1 else F.array_join(F.filter(F.array(*texts), lambda x: x != ""), "\n\n")


def _is_text(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v) == "STRING", F.lit(False))


def _said(v: Column) -> Column:
    """The text of a variant: a string (or number), an object with a text, or a list of such parts."""

    def one(p: Column) -> Column:
        return F.when(F.schema_of_variant(p).startswith("OBJECT"), F.try_variant_get(p, "$.text", "string")).otherwise(F.try_variant_get(p, "$", "string"))

    parts = F.array_join(F.transform(F.try_variant_get(v, "$", "array<variant>"), one), "")
    return F.when(F.schema_of_variant(v).startswith("ARRAY"), parts).otherwise(one(v))


def _first(v: Column, names: tuple[str, ...]) -> Column:
    return F.coalesce(*[F.try_variant_get(v, f"$.{n}", "variant") for n in names])


def _loosely(v: Column) -> tuple[Column, Column]:
    """layout and turns by the first of LOOSE whose required paths a record has; null without any."""
    none = F.lit(None).cast("array<struct<role:string,text:string>>")
    layout, turns = F.lit(None).cast("string"), none
    for m in reversed(LOOSE):
        if m.lists:
            all_ = [F.try_variant_get(v, p, "array<variant>") for p in m.lists]
            whole = lambda x: _first(x, ROLE_FIELDS).isNotNull() & _first(x, TEXT_FIELDS).isNotNull()
            fits = [F.coalesce(F.exists(a, whole), F.lit(False)) for a in all_]
            own = F.transform(F.concat(*all_), lambda x: F.struct(_said(_first(x, ROLE_FIELDS)).alias("role"), _said(_first(x, TEXT_FIELDS)).alias("text")))
        else:
            fits = [_is_text(F.try_variant_get(v, paths[0], "variant")) for _, paths in m.fields]
            own = F.array(*[F.struct(F.lit(r).alias("role"), _joined([F.coalesce(F.try_variant_get(v, p, "string"), F.lit("")) for p in paths]).alias("text")) for r, paths in m.fields])
        fit = fits[0]
        for f in fits[1:]:
            fit = fit & f
        layout, turns = F.when(fit, m.name).otherwise(layout), F.when(fit, own).otherwise(turns)
    system = F.try_variant_get(v, "$.system", "variant")
    before = F.array(F.struct(F.lit("system").alias("role"), F.try_variant_get(v, "$.system", "string").alias("text")))
    return layout, F.when(turns.isNotNull() & _is_text(system), F.concat(before, turns)).otherwise(turns)


def unknown(records: DataFrame, record: str = "record") -> DataFrame:
    """How many records have no turns, by fingerprint (null: no JSON): fingerprint, n."""
    return canonical(records, record).where("turns is null").groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n"))


def canonical(records: DataFrame, record: str = "record") -> DataFrame:
    """``records`` with fingerprint, layout and turns (array of role and text), for each JSON text in ``record``."""
    spark = records.sparkSession
    v = records.withColumn("__v", F.try_parse_json(F.col(record))).withColumn("fingerprint", fingerprint(F.col("__v")))
    known = spark.sql("VALUES " + ", ".join(f"('{name}', sha2('{shape}', 256))" for shape, name in shapes().items())).toDF("layout", "fingerprint")
    v = v.join(F.broadcast(known), "fingerprint", "left")
    turns = F.lit(None).cast("array<struct<role:string,text:string>>")
    for m in {m.name: m for m in reversed(MAPPINGS)}.values():
        if m.path:
            rows = F.try_variant_get("__v", m.path, f"array<struct<{m.role}:string,{m.text}:string>>")
            own = F.transform(rows, _renamed(m))
        else:
            own = F.array(*[F.struct(F.lit(r).alias("role"), _joined([F.try_variant_get("__v", p, "string") for p in paths]).alias("text")) for r, paths in m.fields])
        turns = F.when(F.col("layout") == m.name, own).otherwise(turns)
    loose, loose_turns = _loosely(F.col("__v"))
    turns = F.when(F.col("layout").isNotNull(), turns).otherwise(loose_turns)
    v = v.withColumn("__turns", turns).withColumn("layout", F.coalesce("layout", loose))
    spelled = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])

    def clean(t: Column) -> Column:
        role = F.coalesce(t["role"], F.lit(""))
        return F.struct(F.coalesce(spelled[role], role).alias("role"), F.coalesce(t["text"], F.lit("")).alias("text"))

    return v.withColumn("turns", F.transform("__turns", clean)).drop("__v", "__turns")


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", "<$1|")


def escaped_role(role: Column) -> Column:
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescaped_role(role: Column) -> Column:
    pairs = F.split(unescaped(role), r"\\\\")
    return F.array_join(F.transform(pairs, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def formatted(turns: DataFrame) -> DataFrame:
    """``turns`` with ``formatted`` and ``mask`` (array of start and end), from its array column turns."""
    cells = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), F.concat(F.lit(START), escaped_role(t["role"]), F.lit("\n")).alias("head"), escaped(t["text"]).alias("body")))
    df = turns.withColumn("__cells", cells)
    tail = len(END) + 1
    text = F.array_join(F.transform("__cells", lambda c: F.concat(c["head"], c["body"], F.lit(END + "\n"))), "")
    df = df.withColumn("formatted", F.coalesce(text, F.lit("")))

    def add(at: Column, c: Column) -> tuple[Column, dict[str, Column]]:
        start = at + F.length(c["head"])
        end = start + F.length(c["body"])
        one = F.array(F.struct(start.alias("start"), end.alias("end")))
        return end + tail, {"mask": F.when(c["role"] == "assistant", one).otherwise(F.array().cast(MASK))}

    mask = scan(F.col("__cells"), F.lit(0), {"mask": "struct<start:int,end:int>"}, add, lambda a: a["mask"])
    return df.withColumn("mask", F.coalesce(mask, F.array().cast(MASK))).drop("__cells")


def parsed(text: Column) -> Column:
    """The turns of a formatted text."""
    pieces = F.filter(F.split(text, r"<\|im_start\|>"), lambda p: p != "")

    def turn(p: Column) -> Column:
        head = F.substring_index(p, "\n", 1)
        body = F.substr(p, F.length(head) + 2, F.length(p) - F.length(head) - 1 - len(END) - 1)
        return F.struct(unescaped_role(head).alias("role"), unescaped(body).alias("text"))

    return F.transform(pieces, turn)


def masked(text: Column, mask: Column) -> Column:
    """The unescaped texts under the mask, in order. A place in a text is found by counting from its start, so that spans are cut out of the pieces that blocks of spans lie in: m spans cost as much as 2 sqrt(m) readings of the text."""

    def cut(all_: Column) -> Column:
        size = F.ceil(F.sqrt(F.greatest(F.size(all_), F.lit(1)))).cast("int")
        blocks = F.filter(F.transform(F.sequence(F.lit(0), size), lambda k: F.slice(all_, k * size + 1, size)), lambda b: F.size(b) > 0)

        def of(b: Column) -> Column:
            base = F.element_at(b, 1)["start"]
            near = F.substr(text, base + 1, F.element_at(b, -1)["end"] - base)
            return let(near, lambda t: F.transform(b, lambda s: unescaped(F.substr(t, s["start"] - base + 1, s["end"] - s["start"]))))

        return F.flatten(F.transform(blocks, of))

    return let(mask, cut)


def records_of(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``place``, ``part``, ``record`` for rows of conv_id, turn, role, text: JSON records of each conversation.

    A user and an assistant turn make a record of a pair, in one of three layouts by a hash of conv_id; each turn of what begins
    with a system turn makes a list of one value, each turn of all else a list of one message, with an id or without. A text of
    more than PIECE characters comes in several records, by part.
    """
    turn = F.struct("turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    convs = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("t"))
    roles = F.transform("t", lambda x: x["role"])
    one_of = lambda name, n: F.concat(F.lit(name), F.pmod(F.xxhash64("conv_id"), F.lit(n)).cast("string"))
    convs = convs.withColumn("kind", F.when(roles == F.array(F.lit("user"), F.lit("assistant")), one_of("pair", len(PAIRS))).when(F.element_at(roles, 1) == "system", "values").otherwise(one_of("messages", 2)))
    pair = F.array(F.struct(F.lit(0).alias("place"), F.lit("").alias("role"), F.element_at("t", 1)["text"].alias("text"), F.element_at("t", -1)["text"].alias("reply")))
    each = F.transform("t", lambda x, i: F.struct(i.alias("place"), x["role"].alias("role"), x["text"].alias("text"), F.lit("").alias("reply")))
    cells = convs.select("conv_id", "kind", F.explode(F.when(F.col("kind").startswith("pair"), pair).otherwise(each)).alias("c")).select("conv_id", "kind", "c.*")

    def cut(text: str, k: Column) -> Column:
        return F.substr(F.col(text), k * PIECE + 1, F.lit(PIECE)).alias(text)

    last = F.expr(f"cast((greatest(length(text), length(reply), 1) - 1) div {PIECE} as int)")
    pieces = F.transform(F.sequence(F.lit(0), last), lambda k: F.struct(k.alias("part"), cut("text", k), cut("reply", k)))
    pieces = cells.select("conv_id", "kind", "place", "role", F.explode(pieces).alias("p")).select("conv_id", "kind", "place", "role", "p.*")
    kinds = {f"pair{k}": F.struct(F.col("text").alias(ask), F.col("reply").alias(reply)) for k, (ask, reply) in enumerate(PAIRS)}
    kinds["values"] = F.struct(F.array(F.struct(F.col("role").alias("from"), F.col("text").alias("value"))).alias("conversations"))
    messages = F.array(F.struct("role", F.col("text").alias("content"))).alias("messages")
    kinds["messages0"], kinds["messages1"] = F.struct(messages), F.struct(F.col("place").alias("id"), messages)
    record = F.lit(None).cast("string")
    for name, made in kinds.items():
        record = F.when(F.col("kind") == name, F.to_json(made)).otherwise(record)
    return pieces.select("conv_id", "place", "part", record.alias("record"))


def turns_of(records: DataFrame) -> DataFrame:
    """``conv_id`` and ``turns`` of the records that ``records_of`` makes. One that doesn't parse is an error."""
    failed = F.raise_error(F.concat(F.lit("no turns in a record of conversation "), F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))))
    got = canonical(records).select("conv_id", "place", "part", F.posexplode(F.coalesce("turns", failed)).alias("i", "x"))
    # all by conv_id, as the records are dealt out already
    whole = got.groupBy("conv_id", "place", "i").agg(F.sort_array(F.collect_list(F.struct("part", "x.role", "x.text"))).alias("p"))
    text = F.array_join(F.transform("p", lambda x: x["text"]), "")
    turns = whole.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("place", "i", F.element_at("p", 1)["role"].alias("role"), text.alias("text")))).alias("t"))
    return turns.select("conv_id", F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("turns"))


def digest(rows: DataFrame) -> DataFrame:
    """For each conversation, from its formatted text: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    out = formatted(turns_of(records_of(rows))).select("conv_id", "formatted", "mask")
    back = out.withColumn("turns", parsed(F.col("formatted"))).withColumn("loss", F.array_join(masked(F.col("formatted"), F.col("mask")), ""))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
