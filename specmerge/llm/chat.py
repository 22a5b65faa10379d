r"""Chat formatting: schema fingerprints select a declarative mapping to canonical turns.

A record is a JSON object of any layout. Its fingerprint is the hash of its nested field paths, the parsed
record's schema without scalar types. MAPPINGS says for each layout which paths it has and where the turns
are; a record's fingerprint selects the mapping. Turns are then put in a template:

    <|im_start|>ROLE\nTEXT<|im_end|>\n

Control strings inside a text get a backslash after their first character, one more if they have some
already, and lose one when read back: the escape is exact, and no text can open or close a turn. Roles are
percent-encoded. Output is the string and its segments with a loss flag, set on the assistant's texts alone.

Everything is a DataFrame expression; a record is one row and costs time in proportion to its length. The
fingerprint is taken of the record's skeleton, without its texts, as parsers bound the length of these.

Defined cases: null texts and roles are empty; a record with no turns gives an empty string; records of an
unknown layout are kept, with null turns and segments and mapping null; other columns pass through, but for mapping,
turns, segments and formatted, which are the results. Texts of any length are formatted whole.
"""

from __future__ import annotations

import hashlib
import itertools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
_CONTROL = r"([<\[])(\\*)(\|im_start\|>|\|im_end\|>|\|endoftext\|>|/?s>|/?INST\]|\|user\|>|\|assistant\|>|\|system\|>)"
_ESCAPED = _CONTROL.replace(r"(\\*)", r"\\(\\*)", 1)
#: Texts are read whole, as long as a string can be.
WHOLE = {"maxStringLen": str(2**31 - 1)}
TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Mapping:
    """Layout of a record.

    Either ``turns`` names a list of objects with the fields ``role`` and ``text``, or ``fields`` lists
    (field, role) in order of the turns; fields that are joined to the turn before have the role "+".
    ``optional`` fields may be absent, and ``extra`` fields may be present and are ignored.
    """

    name: str
    turns: str = ""
    role: str = ""
    text: str = ""
    fields: tuple[tuple[str, str], ...] = ()
    optional: tuple[str, ...] = ()
    extra: tuple[str, ...] = ("id", "source")
    roles: tuple[tuple[str, str], ...] = ()

    def paths(self) -> list[str]:
        """All nested schemas that the layout can have."""
        base = [self.turns] if self.turns else [f for f, _ in self.fields if f not in self.optional]
        out = []
        more = (*self.optional, *self.extra)
        for k in range(len(more) + 1):
            for some in itertools.combinations(more, k):
                for item in (f"ARRAY<OBJECT<{', '.join(sorted((self.role, self.text)))}>>", "ARRAY<>") if self.turns else ("",):
                    out.append("OBJECT<" + ", ".join(f"{p}: {item}" if p == self.turns else p for p in sorted((*base, *some))) + ">")
        return out

    def read(self, record: Column) -> Column:
        if self.turns:
            found = F.from_json(record, f"`{self.turns}` array<struct<`{self.role}`:string,`{self.text}`:string>>", WHOLE)[self.turns]
            names = F.create_map(*(F.lit(x) for kv in self.roles for x in kv)) if self.roles else F.create_map().cast("map<string,string>")
            role = lambda t: F.coalesce(F.try_element_at(names, t[self.role]), t[self.role], F.lit(""))
            return F.transform(found, lambda t: F.struct(role(t).alias("role"), F.coalesce(t[self.text], F.lit("")).alias("text")))
        row = F.from_json(record, ", ".join(f"`{f}` string" for f, _ in self.fields), WHOLE)
        parts: list[tuple[str, list[str]]] = []
        for field, role in self.fields:
            if role == "+":
                parts[-1][1].append(field)
            else:
                parts.append((role, [field]))
        turns = []
        for role, fields in parts:
            there = F.lit(False)
            for f in fields:
                there = there | row[f].isNotNull()
            text = F.concat_ws("\n", *(F.when(row[f] != "", row[f]) for f in fields))
            turns.append(F.when(there | F.lit(fields[0] not in self.optional), F.struct(F.lit(role).alias("role"), text.alias("text"))))
        return F.array_compact(F.array(*turns))


#: Names that one layout gives the roles.
ROLES = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"), ("model", "assistant"))

MAPPINGS = (
    Mapping("messages", turns="messages", role="role", text="content"),
    Mapping("conversations", turns="conversations", role="from", text="value", roles=ROLES),
    Mapping("instruction", fields=(("system", "system"), ("instruction", "user"), ("input", "+"), ("output", "assistant")), optional=("system", "input")),
    Mapping("prompt", fields=(("system", "system"), ("prompt", "user"), ("completion", "assistant")), optional=("system",)),
    Mapping("response", fields=(("system", "system"), ("prompt", "user"), ("response", "assistant")), optional=("system",)),
    Mapping("question", fields=(("question", "user"), ("answer", "assistant"))),
)


def skeleton(record: Column) -> Column:
    """A JSON record with empty strings for its texts, and of equal objects that stand side by side in a list only one: the same paths, whatever the texts' lengths."""
    plain = F.replace(F.replace(record, F.lit("\\\\"), F.lit("??")), F.lit('\\"'), F.lit("??"))  # escaped characters; a key with some isn't one of a mapping
    bound = lambda x, f: F.get(F.transform(F.array(x), f), F.lit(0))  # noqa: E731  computes x once
    # every second piece between quotes is a string, and a key if a colon follows
    key = lambda p, i: F.get(p, i + 1).rlike(r"^\s*:")
    blank = bound(F.split(plain, '"'), lambda p: F.array_join(F.transform(p, lambda x, i: F.when((i % 2 == 1) & ~key(p, i), "").otherwise(x)), '"'))
    return bound(F.split(blank, r"(?<=\}),\s*(?=\{)"), lambda p: F.array_join(F.filter(p, lambda x, i: (i == 0) | (x != F.get(p, i - 1))), ","))


def fingerprint(record: Column) -> Column:
    """Hash of the nested field paths of a JSON record; null if it isn't JSON."""
    schema = F.schema_of_variant(F.try_parse_json(skeleton(record)))
    schema = F.regexp_replace(schema, r"(: |<)(?!OBJECT|ARRAY)[A-Z]+(\([0-9,]*\))?(?=[,>])", "$1")
    return F.sha2(F.regexp_replace(schema, r": (?=[,>])", ""), 256)


def canonical(df: DataFrame, record: str = "record", mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """df with mapping, the layout's name, and turns."""
    known = {hashlib.sha256(p.encode()).hexdigest(): m for m in mappings for p in m.paths()}
    name = F.create_map(*(F.lit(x) for k, m in known.items() for x in (k, m.name)))
    own = fresh(df, "__name")
    df = df.withColumn(own, F.try_element_at(name, fingerprint(F.col(record))))
    turns = F.lit(None).cast(TURNS)
    for m in mappings:
        turns = F.when(F.col(own) == m.name, m.read(F.col(record))).otherwise(turns)
    return df.withColumn("turns", turns).withColumn("mapping", F.when(F.col("turns").isNotNull(), F.col(own))).drop(own)


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def render(df: DataFrame) -> DataFrame:
    """df with segments (text, loss) of the template and formatted, their concatenation, from turns."""
    segments = F.flatten(
        F.transform(
            "turns",
            lambda t: F.array(
                F.struct(F.concat(F.lit(OPEN), F.url_encode(t["role"]), F.lit("\n")).alias("text"), F.lit(False).alias("loss")),
                F.struct(escape(t["text"]).alias("text"), (t["role"] == "assistant").alias("loss")),
                F.struct(F.lit(CLOSE).alias("text"), F.lit(False).alias("loss")),
            ),
        )
    )
    df = df.withColumn("segments", segments)
    return df.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted string."""
    parts = F.filter(F.split(formatted, r"\Q" + CLOSE + r"\E"), lambda p: p != "")

    def turn(p: Column) -> Column:
        return F.struct(F.url_decode(F.substring_index(F.substr(p, F.lit(len(OPEN) + 1)), "\n", 1)).alias("role"), unescape(F.substr(p, F.instr(p, "\n") + 1)).alias("text"))

    return F.transform(parts, turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def format_chats(df: DataFrame, record: str = "record", mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    return render(canonical(df, record, mappings))


def _written(m: Mapping) -> tuple[Column, Column]:
    """Whether a layout can hold turns, and the struct that holds them."""
    roles = F.transform("turns", lambda t: t["role"])
    if m.turns:
        names = {b: a for a, b in reversed(m.roles)}
        table = F.create_map(*(F.lit(x) for kv in names.items() for x in kv)) if names else F.create_map().cast("map<string,string>")
        turn = lambda t: F.struct(F.coalesce(F.try_element_at(table, t["role"]), t["role"]).alias(m.role), t["text"].alias(m.text))
        return ~F.exists(roles, lambda r: r.isin([a for a, _ in m.roles])), F.struct(F.transform("turns", turn).alias(m.turns))
    fields = [(f, r) for f, r in m.fields if r != "+"]
    must, may = [r for f, r in fields if f not in m.optional], [r for f, r in fields if f in m.optional]
    fits = (roles == F.array(*map(F.lit, must))) | (roles == F.array(*map(F.lit, [*may, *must])))
    text = lambda role: F.get(F.filter("turns", lambda t: t["role"] == role), F.lit(0))["text"]
    return fits, F.struct(*(text(r).alias(f) for f, r in fields))


def records_of(rows: DataFrame, mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """conv_id and record, a JSON object, of a table with a row per turn (conv_id, turn, role, text).

    A conversation's rows are ordered by turn, then role and text, nulls first. Conversations are dealt by the hash of conv_id over
    the layouts that can hold theirs: a list of turns, or a field for each of at most one system text, one
    prompt and one answer.
    """
    turns = F.sort_array(F.collect_list(F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))))
    rows = rows.groupBy("conv_id").agg(turns.alias("turns"))
    fit, made = zip(*(_written(m) for m in mappings), strict=True)
    options = F.array_compact(F.array(*(F.when(ok, i) for i, ok in enumerate(fit))))
    rows = rows.withColumn("__way", F.get(options, F.pmod(F.xxhash64("conv_id"), F.size(options)).cast("int")))
    record = F.lit(None).cast("string")
    for i, x in enumerate(made):
        record = F.when(F.col("__way") == i, F.to_json(x)).otherwise(record)
    return rows.select("conv_id", record.alias("record"))
