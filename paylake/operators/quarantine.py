"""Records that a layer refuses, with what is wrong with each.

Faults, in this order: ``missing_key``; ``malformed`` (another number of fields than the layout
has); ``bad_value:<column>`` (text in a typed column that does not parse); ``bad_date`` and
``bad_amount`` (what gold needs does not convert). Silver refuses records without a key and,
where asked to, malformed ones; gold refuses bad dates and amounts of the others. So raw's
records are silver's and those that silver refuses, silver's are gold's and those that gold does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.functions.scalars import safe_cast_numeric, safe_parse_date
from paylake.schema import KEY, SILVER_FROM_RAW
from paylake.sources.records import CSV_OPTIONS, RECORD

REFUSED_BY, FAULTS, FILE = "refused_by", "faults", "source_file"
_AGAIN = "__again"


def judge(raw: DataFrame, layout: T.StructType, *, refuse_malformed: bool = False) -> DataFrame:
    """Raw records, read with their text, as silver columns with ``faults`` and ``refused_by``.

    The reader gives a record's text where its fields or their number are not as declared.
    Only such text is parsed once more, all fields as text, which tells the two apart.
    ``source_file`` is where the record came from.
    """
    as_text = ", ".join(f"`{name}` STRING" for name in (*layout.names, RECORD))
    options = {k: v for k, v in CSV_OPTIONS.items() if k != "header"}
    options["columnNameOfCorruptRecord"] = RECORD
    again = F.from_csv(F.col(RECORD), as_text, options)
    typed = [f.name for f in layout if f.dataType != T.StringType()]
    # Parsed in a step of its own: each use of the expression would parse again.
    parsed = raw.select("*", F.inline(F.array(F.struct(again.alias(_AGAIN)))))
    odd = F.col(RECORD).isNotNull()
    malformed = odd & F.col(f"{_AGAIN}.{RECORD}").isNotNull()
    bad_values = [
        F.when(
            odd & F.col(n).isNull() & F.col(f"{_AGAIN}.{n}").isNotNull(), F.lit(f"bad_value:{n}")
        )
        for n in typed
    ]
    date, amount = SILVER_FROM_RAW["payment_date_str"], SILVER_FROM_RAW["payment_amount_usd"]
    no_key = F.col(SILVER_FROM_RAW[KEY]).isNull()
    bad_date = safe_parse_date(F.col(date)).isNull()
    bad_amount = safe_cast_numeric(F.col(amount)).isNull()
    faults: list[Column] = [
        F.when(no_key, F.lit("missing_key")),
        F.when(malformed, F.lit("malformed")),
        *bad_values,
        F.when(bad_date, F.lit("bad_date")),
        F.when(bad_amount, F.lit("bad_amount")),
    ]
    by_silver = no_key | (malformed if refuse_malformed else F.lit(False))
    return parsed.select(
        *[F.col(src).alias(name) for name, src in SILVER_FROM_RAW.items()],
        F.array_compact(F.array(*faults)).alias(FAULTS),
        F.when(by_silver, F.lit("silver"))
        .when(bad_date | bad_amount, F.lit("gold"))
        .alias(REFUSED_BY),
        F.col(RECORD).alias("record"),
        F.input_file_name().alias(FILE),
    )


def observe_refused(judged: DataFrame, into: Observation) -> DataFrame:
    """Records that silver refuses, counted as they pass."""
    return judged.observe(into, F.count_if(F.col(REFUSED_BY) == "silver").alias("refused"))


def accepted(judged: DataFrame) -> DataFrame:
    """Silver's rows: all that silver does not refuse."""
    kept = judged.filter(F.coalesce(F.col(REFUSED_BY), F.lit("")) != "silver")
    return kept.select(*SILVER_FROM_RAW)


def refused(judged: DataFrame) -> DataFrame:
    """The quarantine: every record that some layer refuses, as it is judged."""
    return judged.filter(F.col(REFUSED_BY).isNotNull())


def balance(raw: DataFrame, silver: DataFrame, gold: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Rows of each layer and of the quarantine, as one row; both differences must be 0."""
    rows = F.count(F.lit(1))
    by = {layer: F.count_if(F.col(REFUSED_BY) == layer) for layer in ("silver", "gold")}
    counts = (
        raw.agg(rows.alias("raw"))
        .crossJoin(silver.agg(rows.alias("silver")))
        .crossJoin(gold.agg(rows.alias("gold")))
        .crossJoin(quarantine.agg(*[n.alias(f"refused_by_{layer}") for layer, n in by.items()]))
    )
    return counts.select(
        "*",
        (F.col("raw") - F.col("silver") - F.col("refused_by_silver")).alias("raw_left"),
        (F.col("silver") - F.col("gold") - F.col("refused_by_gold")).alias("silver_left"),
    )


def faults_by_file(quarantine: DataFrame) -> DataFrame:
    """How many refused records of each file have each fault."""
    each = quarantine.select(FILE, REFUSED_BY, F.explode(FAULTS).alias("fault"))
    return each.groupBy(FILE, REFUSED_BY, "fault").agg(F.count(F.lit(1)).alias("record_count"))
