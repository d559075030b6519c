"""Chat formatting: heterogeneous conversation layouts to canonical turns, to one templated text.

Layouts are told apart by a fingerprint, the hash of their nested field paths; each fingerprint
selects a declarative mapping to canonical turns (conv_id, turn, role, text). ``canonical_turns``
takes frames (flat turn rows, arrays of messages, instruction or prompt columns),
``canonical_records`` rows of JSON text of mixed layouts. Everything is built of DataFrame functions.
Fields of other layouts may stand beside those of one: of the layouts whose paths are all there the
one with the flat turn rows counts, else the one with most paths.

Defined cases: a null role or text is empty; turns are ordered by turn (null first), ties by role,
then text; repeated rows are kept as turns of their own; rows of a null conv_id form one
conversation; columns outside the known paths are ignored; an empty table gives an empty result.
A record that is no JSON, or of no known layout, gets the layout ``unknown`` and no turns;
``unknown_records`` returns these whole. A layout's path is there if any element of its array has it.
"""

from functools import reduce

import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

START, END = "<|im_start|>", "<|im_end|>"
TURNS = "array<struct<role:string,text:string>>"
UNKNOWN = "unknown"
# Turns whose loss spans are listed together.
RUN = 128


def _pair(role: str, text: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), text.cast("string").alias("text"))


def _said(get, user: tuple, answer: str, system: str | None = None) -> Column:
    """User parts that are there, joined by an empty line, then the answer."""
    turns = [_pair("user", F.concat_ws("\n\n", *map(get, user))), _pair("assistant", get(answer))]
    return F.array(*([_pair("system", get(system))] if system else []), *turns)


def _messages(get, field: str, role: str, text: str, roles: dict | None = None) -> Column:
    """Turns of an array of objects, with role names mapped where the layout has its own."""
    known = F.create_map(*[F.lit(x) for kv in (roles or {}).items() for x in kv]) if roles else None

    def turn(m):
        name = m[role]
        return F.struct((F.coalesce(known[name], name) if roles else name).alias("role"),
                        m[text].alias("text"))
    return F.transform(get(field, f"array<struct<{role}:string,{text}:string>>"), turn)


# Role names of the layout that writes "from" and "value".
SHARED_ROLES = {"human": "user", "gpt": "assistant"}

# A layout: its field paths and how they become turns. ``get`` reads a path with a type.
LAYOUTS = {
    "rows": (("role", "text", "turn"), lambda get: F.array(F.struct(get("role").alias("role"), get("text").alias("text")))),
    "messages": (("messages[].content", "messages[].role"),
                 lambda get: _messages(get, "messages", "role", "content")),
    "messages of text": (("messages[].role", "messages[].text"),
                         lambda get: _messages(get, "messages", "role", "text")),
    "shared": (("conversations[].from", "conversations[].value"),
               lambda get: _messages(get, "conversations", "from", "value", SHARED_ROLES)),
    "prompt": (("prompt", "response"), lambda get: _said(get, ("prompt",), "response")),
    "completion": (("completion", "prompt"), lambda get: _said(get, ("prompt",), "completion")),
    "instruction": (("instruction", "output"), lambda get: _said(get, ("instruction",), "output")),
    "instruction with input": (("input", "instruction", "output"),
                               lambda get: _said(get, ("instruction", "input"), "output")),
    "system and prompt": (("prompt", "response", "system"),
                          lambda get: _said(get, ("prompt",), "response", "system")),
}
ROWS = "rows"
KNOWN = sorted({p for paths, _ in LAYOUTS.values() for p in paths})
# In order of preference where the paths of several are there.
PREFERRED = sorted(LAYOUTS, key=lambda name: (name != ROWS, -len(LAYOUTS[name][0]), name))


def fingerprint(paths) -> int:
    """The hash of sorted field paths, as a signed long (equal to Spark's xxhash64 of the string)."""
    value = xxhash.xxh64_intdigest("\n".join(sorted(paths)).encode(), seed=42)
    return value - (1 << 64) if value >> 63 else value


def field_paths(schema: T.DataType, prefix: str = "") -> list[str]:
    """Nested paths of a schema's leaves; elements of arrays are written [] ."""
    if isinstance(schema, T.ArrayType):
        return field_paths(schema.elementType, f"{prefix}[]")
    if isinstance(schema, T.StructType):
        dot = f"{prefix}." if prefix else ""
        return [p for f in schema.fields for p in field_paths(f.dataType, dot + f.name)]
    return [prefix]


MAPPINGS = {fingerprint(paths): (name, mapping) for name, (paths, mapping) in LAYOUTS.items()}


def layout_of(paths) -> str:
    """The name of the layout of a set of field paths: that of its fingerprint, or the preferred one among
    those whose paths are all there."""
    found = [p for p in paths if p in KNOWN]
    exact = MAPPINGS.get(fingerprint(found))
    return exact[0] if exact else next((n for n in PREFERRED if set(LAYOUTS[n][0]) <= set(found)), UNKNOWN)


def canonical_turns(df: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """(conv_id, turn, role, text) of a frame; the fingerprint of its field paths picks the mapping."""
    paths = field_paths(df.schema)
    name = layout_of(paths)
    if name == UNKNOWN:
        raise ValueError(f"no mapping for a layout with the fields {[p for p in paths if p in KNOWN]}")

    def get(path, kind="string"):
        return F.col(path).cast(kind) if kind == "string" else F.transform(
            F.col(path), lambda m: F.struct(*[m[f.name].cast("string").alias(f.name) for f in
                                              T.DataType.fromDDL(kind).elementType.fields]))
    _, mapping = MAPPINGS[fingerprint(LAYOUTS[name][0])]
    key = F.col(conversation).alias("conv_id")
    if name == ROWS:  # every row is one turn, with a number of its own
        return df.select(key, "turn", mapping(get).alias("turns")).select("conv_id", "turn", F.inline("turns"))
    return _exploded(df.select(key, mapping(get).alias("turns")))


def with_layout(df: DataFrame, column: str) -> DataFrame:
    """Adds the parsed record, its fingerprint and the name of its layout."""
    def there(path):
        outer, _, inner = path.partition("[].")
        if not inner:
            return F.try_variant_get("record", f"$.{path}", "variant").isNotNull()
        items = F.try_variant_get("record", f"$.{outer}", "array<variant>")
        return F.exists(items, lambda m: F.try_variant_get(m, f"$.{inner}", "variant").isNotNull())

    found = {p: F.coalesce(there(p), F.lit(False)) for p in KNOWN}
    listed = F.array_join(F.array_compact(F.array(*[F.when(f, F.lit(p)) for p, f in found.items()])), "\n")
    records = [n for n in PREFERRED if n != ROWS]
    named = F.lit(UNKNOWN)
    for name in reversed(records):
        named = F.when(reduce(Column.__and__, [found[p] for p in LAYOUTS[name][0]]), name).otherwise(named)
    for name in records:
        named = F.when(F.col("fingerprint") == fingerprint(LAYOUTS[name][0]), name).otherwise(named)
    return (df.withColumn("record", F.try_parse_json(column))
            .withColumn("fingerprint", F.xxhash64(listed)).withColumn("layout", named))


def canonical_records(df: DataFrame, column: str, conversation: str = "conv_id") -> DataFrame:
    """(conv_id, turn, role, text) of JSON records, each mapped by its own layout."""
    def get(path, kind="string"):
        return F.try_variant_get("record", f"$.{path}", kind)

    turns = F.lit(None).cast(TURNS)
    for name, (_, mapping) in LAYOUTS.items():
        if name != ROWS:
            turns = F.when(F.col("layout") == name, mapping(get).cast(TURNS)).otherwise(turns)
    return _exploded(with_layout(df, column).select(F.col(conversation).alias("conv_id"), turns.alias("turns")))


def unknown_records(df: DataFrame, column: str) -> DataFrame:
    """The rows whose record has no known layout, as they came."""
    return with_layout(df.select(F.struct("*").alias("row"), column), column).where(
        F.col("layout") == UNKNOWN).select("row.*")


def _exploded(df: DataFrame) -> DataFrame:
    return (df.select("conv_id", F.posexplode("turns").alias("turn", "said"))
            .select("conv_id", F.col("turn").cast("long").alias("turn"), "said.role", "said.text"))


def escaped(text: Column) -> Column:
    """No control string survives: after every "<|" stands a further "|"."""
    return F.replace(text, F.lit("<|"), F.lit("<||"))


def unescaped(text: Column) -> Column:
    return F.replace(text, F.lit("<||"), F.lit("<|"))


def escaped_role(role: Column) -> Column:
    """As texts; line ends, which close a role, are written "<|n"."""
    return F.replace(escaped(role), F.lit("\n"), F.lit("<|n"))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("<|n"), F.lit("\n")))


def formatted(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss): one templated text per conversation and its loss mask.

    ``loss`` holds the spans (start from 1, length; in characters) of assistant texts.
    """
    empty = F.lit("")
    rows = turns.select("conv_id", F.struct(
        F.col("turn"), F.coalesce("role", empty).alias("role"),
        F.coalesce("text", empty).alias("text")).alias("said"))
    grouped = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("said")).alias("said"))
    parts = F.transform("said", lambda t: F.struct(
        F.concat(F.lit(START), escaped_role(t["role"]), F.lit("\n")).alias("head"),
        escaped(t["text"]).alias("body"), (t["role"] == "assistant").alias("learned")))
    tail = f"{END}\n"
    state = "struct<at:int,spans:array<struct<start:int,chars:int>>>"
    size = lambda p: F.length(p["head"]) + F.length(p["body"]) + F.lit(len(tail))

    def step(acc, p):
        start, chars = acc["at"] + F.length(p["head"]), F.length(p["body"])
        span = F.struct(start.alias("start"), chars.alias("chars"))
        spans = F.when(p["learned"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct((start + chars + len(tail)).alias("at"), spans.alias("spans")).cast(state)

    def from_(at):
        return F.struct(at.alias("at"), F.array().alias("spans")).cast(state)

    # Runs of RUN turns, each told where it starts: the spans of long conversations are not copied turn by turn.
    run = lambda i: F.slice("parts", i * RUN + 1, F.lit(RUN))
    runs = F.sequence(F.lit(0), F.floor((F.size("parts") - 1) / RUN).cast("int"))
    sizes = F.transform(runs, lambda i: F.aggregate(run(i), F.lit(0), lambda n, p: n + size(p)))
    starts = F.transform(runs, lambda i: F.aggregate(F.slice("sizes", F.lit(1), i), F.lit(1), lambda n, s: n + s))
    spans = F.flatten(F.transform(runs, lambda i: F.aggregate(run(i), from_(F.get("starts", i)), step)["spans"]))
    text = F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(tail))), "")
    return (grouped.select("conv_id", parts.alias("parts")).select("*", sizes.alias("sizes"))
            .select("*", starts.alias("starts")).select("conv_id", text.alias("formatted"), spans.alias("loss")))


def read_back(chats: DataFrame) -> DataFrame:
    """Adds ``turns`` (role, text) and ``loss_text`` as they are read from the formatted text."""
    def turn(piece):
        role = F.substring_index(piece, "\n", 1)
        body = F.substring(piece, F.length(role) + 2, F.length(piece) - F.length(role) - 2 - len(END))
        return F.struct(unescaped_role(role).alias("role"), unescaped(body).alias("text"))

    pieces = F.split("formatted", r"<\|im_start\|>")
    learned = F.transform("loss", lambda s: unescaped(F.substring(F.col("formatted"), s["start"], s["chars"])))
    return chats.select("*", F.transform(F.slice(pieces, 2, F.size(pieces)), turn).alias("turns"),
                        F.array_join(learned, "").alias("loss_text"))


def digests(conversations: DataFrame) -> DataFrame:
    """Per conversation: number and digest of the turns read back, size and digest of the loss text."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read_back(formatted(canonical_turns(conversations))).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
