"""JSON helpers on VARIANT columns: presence, types and the lenient conversions."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from lograil.functions.text import strip


def parse(text: Column) -> Column:
    """JSON text as a variant, null where it is not valid JSON."""
    return F.try_parse_json(text)


def child(v: Column, key: str) -> Column:
    """Member ``key`` as a variant: null if absent, variant null if it is JSON null."""
    return F.try_variant_get(v, f"$.{key}", "variant")


def is_object(v: Column) -> Column:
    return F.startswith(F.schema_of_variant(v), F.lit("OBJECT"))


_INT_TEXT = r"^[+-]?[0-9]+(?:_[0-9]+)*(?:\.0*)?$"
_PLAIN_INT_TEXT = r"^[+-]?[0-9]+(?:_[0-9]+)*$"


@dataclass
class Member:
    """A member of a JSON object: variant, name of its type (null if absent), and plain text."""

    value: Column
    shape: Column
    plain: Column

    @property
    def present(self) -> Column:
        return self.shape.isNotNull()

    @property
    def is_null(self) -> Column:
        return self.shape == "VOID"

    @property
    def is_text(self) -> Column:
        return self.shape == "STRING"

    @property
    def is_object(self) -> Column:
        return F.startswith(self.shape, F.lit("OBJECT"))

    @property
    def is_number(self) -> Column:
        return self.shape.isin("BIGINT", "DOUBLE", "FLOAT") | F.startswith(
            self.shape, F.lit("DECIMAL"))

    @property
    def is_flag(self) -> Column:
        return self.shape == "BOOLEAN"

    def cast(self, kind: str) -> Column:
        return self.plain if kind == "string" else F.try_variant_get(self.value, "$", kind)

    def text(self) -> Column:
        """The member if it is a JSON string."""
        return F.when(self.is_text, self.cast("string"))

    def as_text(self) -> Column:
        """Any member as text: strings plain, true/false capitalised, containers as JSON."""
        container = self.is_object | F.startswith(self.shape, F.lit("ARRAY"))
        return (
            F.when(container, F.to_json(self.value))
            .when(self.is_flag, F.initcap(self.cast("string")))
            .when(self.present, self.cast("string"))
        )

    def whole_number(self) -> Column:
        """A declared integer: numbers without fraction, integer text, booleans; else null."""
        number, plain = self.cast("double"), strip(self.cast("string"))
        digits = F.regexp_replace(F.regexp_replace(plain, r"\.0*$", ""), "_", "")
        return (
            F.when(self.shape == "BIGINT", self.cast("bigint"))
            .when(self.is_number & (number == F.floor(number)), number.try_cast("bigint"))
            .when(self.is_text & plain.rlike(_INT_TEXT), digits.try_cast("bigint"))
            .when(self.is_flag, self.cast("boolean").cast("bigint"))
        )

    def truncated_number(self) -> Column:
        """An integer from metadata: numbers lose their fraction, text must be an integer."""
        plain = strip(self.cast("string"))
        return (
            F.when(self.is_number, self.cast("double").try_cast("bigint"))
            .when(self.is_text & plain.rlike(_PLAIN_INT_TEXT),
                  F.regexp_replace(plain, "_", "").try_cast("bigint"))
            .when(self.is_flag, self.cast("boolean").cast("bigint"))
        )

    def flag(self) -> Column:
        """A declared boolean: true/false, 0/1 and the usual words; else null."""
        word, number = F.lower(self.cast("string")), self.cast("double")
        return (
            F.when(self.is_flag, self.cast("boolean"))
            .when(self.is_number, F.when(number == 1, True).when(number == 0, False))
            .when(self.is_text & word.isin("1", "t", "true", "y", "yes", "on"), True)
            .when(self.is_text & word.isin("0", "f", "false", "n", "no", "off"), False)
        )

    def has_value(self) -> Column:
        """Whether the value is non-empty: not null, false, 0, "", [] or {}."""
        return F.coalesce(
            F.when(self.is_null, False)
            .when(self.is_text, self.cast("string") != "")
            .when(self.is_flag, self.cast("boolean"))
            .when(self.is_number, self.cast("double") != 0)
            .otherwise(~F.to_json(self.value).isin("{}", "[]")),
            F.lit(False),
        )


def member(v: Column) -> Member:
    """A variant as a member, for a single use."""
    return Member(v, F.schema_of_variant(v), F.try_variant_get(v, "$", "string"))


def with_members(df: DataFrame, v: Column, keys, prefix="_j", texts=None):
    """Look up the named members of an object, all of them in one pass over it.

    Returns the frame with three helper structs (variants, texts, type names), the members by
    key, and the names of the helpers for dropping. A value that is no object has no members,
    and its helpers are null but for the type names.

    ``texts`` are the keys whose members are texts as a rule, by default all: these are made texts
    in the same pass, others only where their text is asked for. To make text of a number, a flag or
    a container costs far more than to find it.
    """
    texts = list(keys if texts is None else texts)
    fields = lambda names, kind: ", ".join(f"`{k}`: {kind}" for k in names)
    values, plain, shapes = f"{prefix}v", f"{prefix}s", f"{prefix}t"
    df = df.withColumns({
        values: F.try_variant_get(v, "$", f"struct<{fields(keys, 'variant')}>"),
        **({plain: F.try_variant_get(v, "$", f"struct<{fields(texts, 'string')}>")} if texts else {}),
    }).withColumn(shapes, F.struct(*[
        F.schema_of_variant(F.col(f"{values}.{k}")).alias(k) for k in keys]))
    return df, _members(keys, values, plain, shapes, texts), [values, *([plain] if texts else []), shapes]


def _members(keys, values, plain, shapes, texts) -> dict[str, Member]:
    return {
        k: Member(F.col(f"{values}.{k}"), F.col(f"{shapes}.{k}"),
                  F.col(f"{plain}.{k}") if k in texts else F.try_variant_get(F.col(f"{values}.{k}"), "$", "string"))
        for k in keys
    }


# The white space of JSON; the strict reading of it; from this length on a text may hold a number that cannot be read.
_BLANKS = " \t\r\n"
_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false", "columnNameOfCorruptRecord": "_bad"}
_LONG = 1000


def with_text_members(df: DataFrame, text: Column, keys, prefix="_j", texts=()):
    """As ``with_members`` for JSON text, which is read once; besides, before the names of the helpers,
    whether ``parse`` gives a value for the text.

    Members taken out of a variant would each carry the key names of the whole document along, from one
    projection to the next. The text is parsed as a whole only if it is no readable object, or a long one.
    """
    values, plain, shapes = f"{prefix}v", f"{prefix}s", f"{prefix}t"
    struct = f"struct<{', '.join(f'`{k}`: variant' for k in keys)}, _bad: string>"
    # Valid JSON is an object exactly if it begins as one.
    begins = F.startswith(F.ltrim(text, F.lit(_BLANKS)), F.lit("{"))
    df = df.withColumn(values, F.when(begins, F.from_json(text, struct, _STRICT)))
    of = lambda k: F.col(f"{values}.{k}")
    df = df.withColumns({
        shapes: F.struct(*[F.schema_of_variant(of(k)).alias(k) for k in keys]),
        **({plain: F.struct(*[F.try_variant_get(of(k), "$", "string").alias(k) for k in texts])} if texts else {}),
    })
    read = F.col(values).isNotNull() & of("_bad").isNull() & (F.octet_length(text) < _LONG)
    valid = F.when(read, True).otherwise(parse(text).isNotNull())
    return df, _members(keys, values, plain, shapes, texts), valid, [values, *([plain] if texts else []), shapes]
