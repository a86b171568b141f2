"""Column functions used by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the letters that make a text publishable.
LETTERS = "[a-zõüöäA-ZÕÜÖÄ]"
COLLATION = "et_CI_RTRIM"


def first_chars(c: Column, n: int) -> Column:
    return F.left(c, F.lit(n))


def bit(c: Column) -> Column:
    """1 for true, 0 for false and null."""
    return F.when(c, F.lit(1)).otherwise(F.lit(0))


def flag(c: Column) -> Column:
    """1 for the text '1', 0 for anything else."""
    return F.when(c.cast("string") == "1", F.lit(1)).otherwise(F.lit(0))


def absent(c: Column, *empties: str) -> Column:
    """Null for any of the given texts; for the empty text when none is given."""
    return F.when(~c.isin(*(empties or ("",))), c)


def number(c: Column) -> Column:
    """A padded code as a number, null when it is none."""
    return c.try_cast("bigint")


def has_letter(c: Column, pattern: str = LETTERS) -> Column:
    return F.coalesce(c.rlike(pattern), F.lit(False))


def one_line(c: Column) -> Column:
    """Runs of line ends become one space; the ends are trimmed."""
    return F.trim(F.regexp_replace(c, r"[\r\n]+", " "))


def later(ts: Column, seconds: int) -> Column:
    return ts + F.make_dt_interval(secs=F.lit(seconds))


def stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd_HHmmss")


def estonian(c: Column) -> Column:
    """For comparing and sorting only; columns are kept in binary order."""
    return F.collate(c, COLLATION)


def full_name(eesnimi: Column, perenimi: Column) -> Column:
    return F.concat_ws(" ", absent(eesnimi), absent(perenimi))


def _one_value(c: Column) -> Column:
    """True for exactly one JSON value.

    The parsers stop at the end of the first value and do not see what follows
    it; put into a list and into an object, only a single whole value holds.
    """
    in_list = F.json_array_length(F.concat(F.lit("["), c, F.lit("]"))) == 1
    in_object = F.json_object_keys(F.concat(F.lit('{"v":'), c, F.lit("}"))).isNotNull()
    return F.coalesce(in_list & in_object, F.lit(False))


def parsed(c: Column) -> Column:
    """Any JSON as a variant, null when the text does not parse."""
    return F.when(_one_value(c), F.try_parse_json(c))


def is_json(c: Column) -> Column:
    """True for a missing text too, as in a check of a column that may be null."""
    return c.isNull() | _one_value(c)


def is_json_list(c: Column) -> Column:
    return F.json_array_length(c).isNotNull() & _one_value(c)


def elements(c: Column, schema: str = "array<string>") -> Column:
    """The elements of a JSON list, null when the text is anything else.

    The kind is tested first: read with a list schema, an object would turn
    into a one-element list.
    """
    return F.when(is_json_list(c), F.from_json(c, schema))


#: strings, brackets and commas, and what else can stand in JSON
_TOKENS = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"|[{}\[\],:]|[^{}\[\],:"\s]+'


def pretty(c: Column) -> Column:
    """A JSON object or list with every level indented by two spaces, values on lines of their own.

    Empty ones stay on one line. Any other text is left unchanged.
    """
    tokens = F.regexp_extract_all(c, F.lit(_TOKENS), F.lit(0))
    return F.when(_one_value(c) & c.rlike(r"^\s*[{\[]"), _laid_out(tokens)).otherwise(c)


def _laid_out(tokens: Column) -> Column:
    """Tokens put together again with line ends and indents."""

    def state(text: Column, depth: Column, before: Column) -> Column:
        return F.struct(text.alias("s"), depth.cast("int").alias("d"), before.alias("p"))

    def step(a: Column, t: Column) -> Column:
        opened = a["p"].isin("{", "[")
        closing = F.when(opened, F.lit("")).otherwise(F.concat(F.lit("\n"), F.repeat(F.lit("  "), a["d"] - 1)))
        fresh = F.concat(F.lit("\n"), F.repeat(F.lit("  "), a["d"]))
        lead = F.when(opened | (a["p"] == ","), fresh).otherwise(F.lit(""))
        deeper = F.when(t.isin("{", "["), a["d"] + 1).otherwise(a["d"])
        return (
            F.when(t.isin("}", "]"), state(F.concat(a["s"], closing, t), a["d"] - 1, t))
            .when(t == ",", state(F.concat(a["s"], t), a["d"], t))
            .when(t == ":", state(F.concat(a["s"], F.lit(": ")), a["d"], t))
            .otherwise(state(F.concat(a["s"], lead, t), deeper, t))
        )

    start = state(F.lit(""), F.lit(0), F.lit(""))
    return F.aggregate(tokens, start, step, lambda a: a["s"])


def has_episode(c: Column, condition) -> Column:
    """True when one list element meets the whole condition."""
    return F.coalesce(F.exists(c, condition), F.lit(False))


def tombstone(kirje: Column, null_too: bool = True) -> Column:
    """An empty text asks for deletion; so does a missing one, if wanted."""
    return F.coalesce(kirje == "", F.lit(null_too))


def tokens(c: Column) -> Column:
    """Lower-case runs of letters and digits, in text order."""
    return F.array_remove(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), "")


def query_tokens(text: str) -> list[str]:
    """The distinct words of a query text, by the same rule as `tokens`."""
    word, words = "", []
    for ch in text.lower() + " ":
        if ch.isalnum():
            word += ch
        elif word:
            words.append(word)
            word = ""
    return list(dict.fromkeys(words))
