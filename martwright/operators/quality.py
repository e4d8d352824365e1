"""Rule table over a DataFrame, each rule applied to the survivors of those before.

Row-local rules are one ``when`` chain naming the first broken rule. UNIQUE
needs the keys of the surviving rows counted: a narrow key-only aggregation,
staged, then joined back as a flag. Rows are never compared as a whole, so
duplicates stay (valid + rejected = input, always).
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.functions.lineage import quoted
from martwright.functions.rules import UNIQUE, Rule, is_known, violation
from martwright.operators.staging import BROADCAST_BYTES, broadcast_within, stage

REJECT_COLUMNS = ("failed_column", "failed_rule", "actual_value", "rejection_reason")
RULE_VIOLATED = "DATA_QUALITY_RULE_FAILED"
PASSED = "__passed"
_BROKEN = "__broken"


@dataclass(frozen=True)
class QualitySplit:
    valid: DataFrame
    # input columns plus REJECT_COLUMNS: the first rule each row breaks
    rejected: DataFrame
    # one row per input row: whether it passed
    verdicts: DataFrame
    # the same, with the input columns, REJECT_COLUMNS (NULL where it passed) and the verdict in PASSED:
    # both outputs from one evaluation
    judged: DataFrame
    skipped: list[Rule]

    def metrics(self) -> DataFrame:
        """total / valid / rejected row counts, one row."""
        return self.verdicts.agg(
            F.count(F.lit(1)).alias("total_records"),
            F.count_if("passed").alias("valid_records"),
            F.count_if(~F.col("passed")).alias("rejected_records"),
        )


def as_rules(rules: DataFrame | Iterable[Rule]) -> list[Rule]:
    """Rules from a metadata table (column_name, rule_type, rule_value) or as given."""
    if not isinstance(rules, DataFrame):
        return list(rules)
    rows = [row.asDict() for row in rules.collect()]
    return [Rule(r["column_name"], r["rule_type"], r.get("rule_value")) for r in rows]


def duplicate_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count. NULL is no key.

    Partial aggregation shrinks a hot key to one row per task before the shuffle.
    """
    columns = [F.col(quoted(key)) for key in keys]
    present = reduce(lambda seen, column: seen & column.isNotNull(), columns, F.lit(True))
    counted = df.filter(present).groupBy(*columns).agg(F.count(F.lit(1)).alias("rows"))
    return counted.filter("rows > 1")


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    return duplicate_rows(df, [key]).select(F.col(quoted(key)))


def rule_violations(df: DataFrame, rule: Rule) -> DataFrame:
    """The rows of ``df`` that break one rule on its own."""
    if rule.kind != UNIQUE:
        return df.filter(violation(rule, df.schema))
    keys = duplicate_keys(df, rule.column)
    return df.join(_known_size(keys, "duplicates"), rule.column, "left_semi").select(*df.columns)


def quality_split(
    df: DataFrame, rules: DataFrame | Iterable[Rule], distinct: bool = False
) -> QualitySplit:
    """Split by the rules in order. Unknown rule types are skipped and listed.

    ``distinct=True`` gives set semantics instead of bag semantics: survivors
    of the first rule lose their exact duplicates before the next rule runs.
    """
    wanted = as_rules(rules)
    active = [rule for rule in wanted if is_known(rule)]
    skipped = [rule for rule in wanted if not is_known(rule)]
    if distinct and active:
        first = quality_split(df, active[:1])
        rest = quality_split(first.valid.dropDuplicates(), active[1:])
        return QualitySplit(
            valid=rest.valid,
            rejected=first.rejected.unionByName(rest.rejected),
            verdicts=first.verdicts.filter(~F.col("passed")).unionAll(rest.verdicts),
            judged=first.judged.filter(~F.col(PASSED)).unionByName(rest.judged),
            skipped=skipped,
        )

    flagged, verdicts = df, []
    for position, rule in enumerate(active):
        if rule.kind == UNIQUE:
            marker = f"__repeated_{position}"
            flagged = _mark_repeated(flagged, verdicts, rule.column, marker)
            verdicts.append(F.col(marker).isNotNull())
        else:
            verdicts.append(violation(rule, df.schema))
    first = [F.when(verdict, F.lit(position)) for position, verdict in enumerate(verdicts)]
    broken = F.coalesce(*first, F.lit(None).cast("int"))
    columns = [F.col(quoted(name)) for name in df.columns]
    marked = flagged.select(*columns, broken.alias(_BROKEN))
    failed = F.col(_BROKEN).isNotNull()
    reasons = [F.when(failed, reason).alias(name) for name, reason in zip(REJECT_COLUMNS, _reasons(active), strict=True)]
    return QualitySplit(
        valid=_unbroken(flagged, verdicts).select(*columns),
        rejected=marked.filter(failed).select(*columns, *_reasons(active)),
        judged=marked.select(*columns, *reasons, (~failed).alias(PASSED)),
        verdicts=flagged.select(broken.isNull().alias("passed")),
        skipped=skipped,
    )


def _unbroken(df: DataFrame, verdicts: list[Column]) -> DataFrame:
    """Rows no verdict is against. One filter each, so that the row-local ones
    move below the join that marks repeated keys."""
    return reduce(lambda rows, verdict: rows.filter(~verdict), verdicts, df)


def _mark_repeated(df: DataFrame, verdicts: list[Column], key: str, marker: str) -> DataFrame:
    """Non-NULL ``marker`` where the key repeats among rows not yet broken."""
    keys = duplicate_keys(_unbroken(df, verdicts), key)
    repeated = _known_size(keys, "duplicates").withColumn(marker, F.lit(True))
    return df.join(repeated, key, "left").select(*[F.col(quoted(c)) for c in df.columns], marker)


def _known_size(keys: DataFrame, label: str) -> DataFrame:
    """Staged keys: broadcast when they measure small, else joined by shuffle."""
    staged = stage(keys, label)
    return broadcast_within(staged.frame, staged.bytes, BROADCAST_BYTES)


def _reasons(rules: list[Rule]) -> list[Column]:
    def pick(values: list[Column]) -> Column:
        chain = F.lit(None).cast("string")
        for position, value in reversed(list(enumerate(values))):
            chain = F.when(F.col(_BROKEN) == position, value).otherwise(chain)
        return chain

    texts = [F.col(quoted(rule.column)).cast("string") for rule in rules]
    return [
        pick([F.lit(rule.column) for rule in rules]).alias("failed_column"),
        pick([F.lit(rule.kind) for rule in rules]).alias("failed_rule"),
        pick(texts).alias("actual_value"),
        F.lit(RULE_VIOLATED).alias("rejection_reason"),
    ]
