"""Documents of several historical shapes, parsed once into VARIANT and kept with their typed parts beside them.

A rule document is an array of rules, an object with them under ``items`` (or another field), or missing. ``shredded`` parses a JSON
column once, tells its shape by type, and takes out what queries need as typed columns; readers of the table neither parse nor
look at shapes, and columns that they don't ask for are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RULES = "array<struct<rule_id:string,severity:string,status:string,metric:string,op:string,threshold:string,actual:string>>"


def shape(doc: Column) -> Column:
    """array, object, scalar, or missing (null, or text that is no JSON)."""
    kind = F.schema_of_variant(doc)
    return F.when(doc.isNull(), "missing").when(kind.startswith("ARRAY"), "array").when(kind.startswith("OBJECT"), "object").otherwise("scalar")


def rules_of(doc: Column, kind: Column, field: str) -> Column:
    """The rules of a document, wherever its shape keeps them; empty if it has none."""
    found = F.when(kind == "array", F.try_variant_get(doc, "$", RULES)).when(kind == "object", F.try_variant_get(doc, f"$.{field}", RULES))
    return F.coalesce(found, F.array().cast(RULES))


def shredded(df: DataFrame, documents: dict[str, str]) -> DataFrame:
    """For each JSON column (name: the field under which an object keeps its rules) the columns <name>_doc (VARIANT), <name>_shape and
    <name>_rules in place of the text."""
    docs = df.withColumns({f"{c}_doc": F.try_parse_json(F.col(c)) for c in documents})
    shapes = docs.withColumns({f"{c}_shape": shape(F.col(f"{c}_doc")) for c in documents})
    rules = {f"{c}_rules": rules_of(F.col(f"{c}_doc"), F.col(f"{c}_shape"), field) for c, field in documents.items()}
    return shapes.withColumns(rules).drop(*documents)


#: Columns of a contract run and the field of an object that holds rules.
QC_DOCUMENTS = {"metrics_json": "_rule_results", "failed_rules_json": "items", "warning_rules_json": "items"}


def rule_rows(runs: DataFrame) -> DataFrame:
    """run_id and one rule a row, from a table that ``shredded`` made with ``QC_DOCUMENTS``: the full list, or else the failed and
    the warning list."""
    stated = F.transform("metrics_json_rules", lambda r: r.withField("status", F.upper(F.coalesce(r["status"], F.lit("PASS")))))
    own = lambda c, word: F.transform(f"{c}_rules", lambda r: r.withField("status", F.lit(word)))
    legacy = F.concat(own("failed_rules_json", "FAIL"), own("warning_rules_json", "WARN"))
    every = F.when((F.col("metrics_json_shape") == "object") & (F.size("metrics_json_rules") > 0), stated).otherwise(legacy)
    return runs.select("run_id", F.explode(every).alias("r")).where("r.rule_id is not null").select("run_id", "r.*")
