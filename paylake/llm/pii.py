"""Personal data: expressions propose spans, check digits confirm them, context adjusts scores.

Built-in functions only. A span is (kind, start, end) in code points, end exclusive.

Base kinds: ``email``, ``ip`` (four numbers up to 255), ``card`` (16 to 19 digits that
pass Luhn), ``phone`` (a plus sign and 8 to 15 digits). Matches are leftmost and do not
overlap within a kind; a match that fails its check is dropped, without a second try.
Added kinds: ``iban`` and ``ssn`` (only with a fitting word nearby). An ``iban`` begins at a
word of upper-case letters and digits and ends at the end of one, has its country's length
(any from 15 to 34 characters, the longest first, if the country has none in ``LENGTHS``)
and passes mod 97. It may begin at every such word that no ``iban`` before it covers.

Every span has a score in percent: a prior of its kind, more if one of the kind's words
stands within ``CONTEXT`` code points on either side. Base spans are reported whatever
their score; ``ssn`` from ``MIN_SCORE`` on.

A null or empty text has no spans. Rows are handled one by one: repeated rows and null
ids come out as they went in. Other columns of the input are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import keyed_text

CONTEXT = 40
# Matches, and code points, that one step of work on a long text takes at a time.
BLOCK, CUT = 128, 4096
MIN_SCORE = 50


@dataclass(frozen=True)
class Kind:
    """``hint`` is a cheap necessary condition; ``pattern`` never backtracks into a run.

    A run that cannot start a match is not tried again from its inside: ``\\G`` lets a
    match begin where the last one ended, the look-behind where a run begins. Where group 1
    has the value, the match itself is only as long as its first ``step`` characters.
    """

    name: str
    hint: str
    pattern: str
    prior: int
    words: str
    step: int = 0


_MAIL = "[A-Za-z0-9._%+-]"
KINDS = (
    Kind(
        "email",
        "@",
        rf"(?:(?<!{_MAIL})|\G){_MAIL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        80,
        "mail|contact|write|kontakt|correo|courriel",
    ),
    Kind(
        "ip",
        r"[0-9]\.[0-9]",
        r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
        55,
        r"\bip\b|address|host|server|login|adresse",
    ),
    Kind(
        "card",
        r"[0-9](?:[\x20-]?[0-9]){15}",
        r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,}+",
        70,
        "card|visa|credit|payment|karte|tarjeta|carte",
    ),
    Kind(
        "phone",
        r"\+[0-9]",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        65,
        "phone|call|tel|mobile|fax|anruf|llam",
    ),
    Kind(
        "iban",
        r"[A-Z][A-Z][0-9][0-9]",
        r"(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})(?![A-Za-z0-9]))"
        r"[A-Z]{2}[0-9]{2}",
        80,
        "iban|account|bank|konto|cuenta|compte",
        4,
    ),
    Kind(
        "ssn",
        r"[0-9]-[0-9][0-9]-[0-9]",
        r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
        25,
        r"\bssn\b|social security|taxpayer",
    ),
)
BASE = ("email", "ip", "card", "phone")
BONUS = 30
# Characters of a country's account numbers, without spaces.
LENGTHS = {
    15: "NO",
    16: "BE",
    18: "DK FI FK FO GL NL SD",
    19: "MK SI",
    20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST",
    26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA",
    30: "JO KW MU YE",
    31: "MT SC",
    32: "LC",
    33: "RU",
}
_SIZED = "|".join(f"(?:{c.replace(' ', '|')}).{{{n - 2}}}" for n, c in LENGTHS.items())
_LISTED = "|".join(" ".join(LENGTHS.values()).split())
_IBAN_LENGTH = f"^(?:{_SIZED}|(?!{_LISTED}).{{15,34}})$"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _mod97(value: Column) -> Column:
    """The remainder that a valid account number leaves as 1; letters count 10 to 35."""
    compact = F.regexp_replace(value, " ", "")
    turned = F.concat(F.substr(compact, F.lit(5)), F.left(compact, F.lit(4)))

    def step(rest: Column, char: Column) -> Column:
        number = F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), char) - 1
        return F.when(number < 10, rest * 10 + number).otherwise(rest * 100 + number) % 97

    return F.aggregate(F.split(turned, ""), F.lit(0), step)


def _account(run: Column) -> Column:
    """The longest account number that a run of words begins with; null if none."""
    words = F.split(run, " ")
    starts = F.transform(
        F.sequence(F.lit(1), F.size(words)), lambda n: F.array_join(F.slice(words, 1, n), " ")
    )
    good = F.filter(
        starts,
        lambda s: F.regexp_replace(s, " ", "").rlike(_IBAN_LENGTH) & (_mod97(s) == 1),
    )
    return F.get(good, F.size(good) - 1)


def _confirmed(kind: str, span: Column) -> Column:
    value = span["value"]
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        digits = _digits(value)
        return F.length(digits).between(16, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    if kind == "ssn":
        return span["score"] >= MIN_SCORE
    return F.lit(True)


def _blocks(items: Column) -> Column:
    """The items in arrays of BLOCK; work that grows with the square stays within one of these."""
    starts = F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK).cast("int"))
    return F.transform(starts, lambda b: F.slice(items, b * BLOCK + 1, BLOCK))


def _running(items: Column, zero: Column, step) -> Column:
    """For each item what ``step`` makes of ``zero`` and the items before it."""

    def within(block: Column, start: Column) -> Column:
        def add(state: Column, x: Column) -> Column:
            return F.struct(
                step(state["now"], x).alias("now"),
                F.concat(state["seen"], F.array(state["now"])).alias("seen"),
            )

        begin = F.struct(start.alias("now"), _empty("bigint").alias("seen"))
        return F.aggregate(block, begin, add, lambda state: state["seen"])

    def whole(block: Column, start: Column) -> Column:
        return F.aggregate(block, start, step)

    # The state before each block, then the states within it.
    return _let(
        _blocks(items),
        lambda blocks: _let(
            F.aggregate(
                blocks,
                F.struct(zero.alias("now"), _empty("bigint").alias("seen")),
                lambda state, block: F.struct(
                    whole(block, state["now"]).alias("now"),
                    F.concat(state["seen"], F.array(state["now"])).alias("seen"),
                ),
                lambda state: state["seen"],
            ),
            lambda starts: F.flatten(
                F.transform(blocks, lambda block, i: within(block, F.get(starts, i)))
            ),
        ),
    )


def _let(value: Column, use) -> Column:
    """``use`` of a value that is worked out once: an array of one stands for its name."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _empty(type_name: str) -> Column:
    return F.array().cast(f"array<{type_name}>")


def _spans(kind: Kind, matches: Column, pieces: Column) -> Column:
    """Spans from a kind's matches and the pieces of text around them."""
    found = F.transform(
        matches,
        lambda m, i: F.struct(
            (_account(m) if kind.name == "iban" else m).alias("value"),
            F.get(pieces, i).alias("before"),
            F.get(pieces, i + 1).alias("after"),
            # What the pattern takes from the text.
            (F.lit(kind.step) if kind.step else F.length(m)).cast("long").alias("taken"),
        ),
    )

    def span(x: Column, at: Column) -> Column:
        start = at + F.length(x["before"])
        after = x["after"]
        if kind.step:
            after = F.substr(after, F.length(x["value"]) - kind.step + 1)
        near = F.concat_ws(
            " ", F.right(x["before"], F.lit(CONTEXT)), F.left(after, F.lit(CONTEXT))
        )
        score = F.lit(kind.prior) + F.when(near.rlike(f"(?i){kind.words}"), BONUS).otherwise(0)
        return F.struct(
            start.alias("start"),
            (start + F.length(x["value"])).alias("end"),
            F.least(score, F.lit(99)).alias("score"),
            x["value"].alias("value"),
        )

    def placed(around: Column) -> Column:
        zero = F.lit(0).cast("long")
        offsets = _running(around, zero, lambda at, x: at + F.length(x["before"]) + x["taken"])
        spans = _let(offsets, lambda o: F.transform(around, lambda x, i: span(x, F.get(o, i))))
        if not kind.step:
            return F.filter(spans, lambda x: _confirmed(kind.name, x))
        good = F.filter(spans, lambda x: x["value"].isNotNull())
        return _let(good, lambda g: F.when(F.size(g) > 0, _apart(g)).otherwise(g))

    none = F.filter(
        F.array(F.lit(None).cast("struct<start:bigint,end:bigint,score:int,value:string>")),
        lambda x: x.isNotNull(),
    )
    return F.when(F.size(matches) > 0, _let(found, placed)).otherwise(none)


def _apart(spans: Column) -> Column:
    """Spans that do not begin within one that was taken before them."""
    taken_to = _running(
        spans,
        F.lit(0).cast("long"),
        lambda to, x: F.when(x["start"] >= to, x["end"]).otherwise(to),
    )
    return _let(
        taken_to, lambda to: F.filter(spans, lambda x, i: x["start"] >= F.get(to, i))
    )


def add_spans(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with a column ``<text>_<kind>`` of spans for each kind.

    Matches first, then the pieces between them: the rows with a match are few, and each
    expression is worked out once.
    """
    own, nothing = F.col(f"`{text}`"), F.array().cast("array<string>")
    hit = {
        k.name: F.regexp_extract_all(own, F.lit(k.pattern), F.lit(1 if k.step else 0)) for k in KINDS
    }
    docs = docs.withColumns(
        {
            f"{text}_{k.name}_found": F.when(own.rlike(k.hint), hit[k.name]).otherwise(nothing)
            for k in KINDS
        }
    )
    docs = docs.withColumns(
        {
            f"{text}_{k.name}_pieces": F.when(
                F.size(f"{text}_{k.name}_found") > 0, F.split(own, k.pattern, -1)
            ).otherwise(nothing)
            for k in KINDS
        }
    )
    return docs.withColumns(
        {
            f"{text}_{k.name}": _spans(
                k, F.col(f"{text}_{k.name}_found"), F.col(f"{text}_{k.name}_pieces")
            )
            for k in KINDS
        }
    ).drop(*[f"{text}_{k.name}_{x}" for k in KINDS for x in ("found", "pieces")])


def _listed(kinds: tuple[str, ...], text: str, field: str | None = None) -> Column:
    def show(kind: str):
        if field:
            return lambda s: s[field].cast("string")
        return lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"])

    return F.array_join(F.concat(*[F.transform(f"{text}_{k}", show(k)) for k in kinds]), ",")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: counts, digest of base spans, all spans and their scores."""
    found = add_spans(keyed_text(docs, id_col, text_col), "text")
    every = tuple(k.name for k in KINDS)
    counts = [F.size(f"text_{k}").cast("long").alias(f"n_{k}") for k in every]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_listed(BASE, "text"), 256).alias("base_sha256"),
        _listed(every, "text").alias("spans"),
        _listed(every, "text", "score").alias("scores"),
    )


def redact(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets and the length set anew.

    Columns, their order and the rows stay. A null text stays null. Where spans of two
    kinds overlap, the one that begins first (then the longer one) names the whole stretch.
    """
    work, columns = "__pii_text", docs.columns
    docs = docs.withColumn(work, F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    docs = add_spans(docs, work)

    def marked(kind: str):
        return lambda s: F.struct(
            s["start"].alias("start"),
            (-s["end"]).alias("back"),
            F.lit(f"[{kind.upper()}]").alias("mark"),
        )

    spans = F.array_sort(F.concat(*[F.transform(f"{work}_{k.name}", marked(k.name)) for k in KINDS]))
    docs = docs.withColumn("__pii_all", spans)
    own = F.col(work)
    cuts = F.regexp_extract_all(own, F.lit(f"(?s).{{1,{CUT}}}"), F.lit(0))

    def clean(cut: Column) -> Column:
        def part(start: Column, end: Column) -> Column:
            """The text from start to end, from the cuts it lies in."""
            first, last = F.floor(start / CUT).cast("int"), F.floor(end / CUT).cast("int")
            begin, stop = (start % CUT).cast("int") + 1, (end % CUT).cast("int")
            within = F.substr(F.get(cut, first), begin, (end - start).cast("int"))
            over = F.concat(
                F.substr(F.get(cut, first), begin, F.lit(CUT)),
                F.array_join(F.slice(cut, first + 2, F.greatest(last - first - 1, F.lit(0))), ""),
                F.coalesce(F.left(F.get(cut, last), stop), F.lit("")),
            )
            return F.when(start >= end, "").when(first == last, within).otherwise(over)

        def piece(s: Column, to: Column) -> Column:
            return F.when(s["start"] >= to, F.concat(part(to, s["start"]), s["mark"])).otherwise("")

        ends = _running(
            F.col("__pii_all"), F.lit(0).cast("long"), lambda to, s: F.greatest(to, -s["back"])
        )
        marks = _let(
            ends, lambda to: F.transform("__pii_all", lambda s, i: piece(s, F.get(to, i)))
        )
        last = F.array_max(F.transform("__pii_all", lambda s: -s["back"]))
        return F.concat(F.array_join(marks, ""), part(last, F.length(own).cast("long")))

    cleaned = _let(cuts, clean)
    touched = F.size("__pii_all") > 0
    docs = docs.withColumn("__pii_new", F.when(touched, cleaned).otherwise(F.col(f"`{text_col}`")))
    new = {text_col: F.col("__pii_new"), length_col: F.length("__pii_new").cast("long")}
    return docs.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in columns])
