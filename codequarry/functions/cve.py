"""Column functions on raw vulnerability records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Schema of a raw record, as far as it is read.
RAW_SCHEMA = """id string, vulnStatus string, published string, lastModified string, descriptions array<struct<lang:string,value:string>>,
    metrics struct<cvssMetricV2:array<struct<type:string,baseSeverity:string,cvssData:struct<vectorString:string,baseScore:double>>>,
                   cvssMetricV31:array<struct<type:string,cvssData:struct<vectorString:string,baseScore:double,baseSeverity:string>>>>,
    weaknesses array<struct<type:string,description:array<struct<lang:string,value:string>>>>, `references` array<struct<url:string>>"""

# Statuses that are kept; entries that name no weakness.
KEPT_STATUS = ["Analyzed", "Modified"]
NO_CWE = ["NVD-CWE-noinfo", "NVD-CWE-Other"]


def english_description(descriptions: Column) -> Column:
    """The first English description; '' without one."""
    return F.coalesce(F.try_element_at(F.filter(descriptions, lambda d: d["lang"] == "en"), F.lit(1))["value"], F.lit(""))


def _primary(entries: Column) -> Column:
    """The last primary entry, or the first where none is."""
    return F.coalesce(F.try_element_at(F.filter(entries, lambda e: e["type"] == "Primary"), F.lit(-1)), F.try_element_at(entries, F.lit(1)))


def cvss(metrics: Column) -> Column:
    """struct(vector, base_score, base_severity, is_v3): version 2 before 3.1; other versions give nulls throughout."""
    v2, v3 = _primary(metrics["cvssMetricV2"]), _primary(metrics["cvssMetricV31"])
    has2, has3 = metrics["cvssMetricV2"].isNotNull(), metrics["cvssMetricV31"].isNotNull()
    pick = lambda a, b: F.when(has2, a).when(has3, b)
    return F.struct(
        pick(v2["cvssData"]["vectorString"], v3["cvssData"]["vectorString"]).alias("vector"), pick(v2["cvssData"]["baseScore"], v3["cvssData"]["baseScore"]).alias("base_score"),
        pick(v2["baseSeverity"], v3["cvssData"]["baseSeverity"]).alias("base_severity"), pick(F.lit(False), F.lit(True)).alias("is_v3"),
    )


def cwe_ids(weaknesses: Column) -> Column:
    """Sorted weaknesses: English values of primary entries; of all entries where those name none; 'CWE-Other' where only
    placeholders were seen; else an empty array."""
    values = lambda ws: F.transform(F.filter(F.flatten(F.transform(ws, lambda w: w["description"])), lambda d: d["lang"] == "en"), lambda d: d["value"])
    real = lambda vs: F.array_sort(F.array_distinct(F.filter(vs, lambda v: ~v.isin(NO_CWE))))
    first, all_ = real(values(F.filter(weaknesses, lambda w: w["type"] == "Primary"))), real(values(weaknesses))
    seen = F.exists(values(weaknesses), lambda v: v.isin(NO_CWE))
    return F.when(F.size(first) > 0, first).when(F.size(all_) > 0, all_).when(seen, F.array(F.lit("CWE-Other"))).otherwise(F.coalesce(all_, F.array().cast("array<string>")))


def records(raw: DataFrame) -> DataFrame:
    """Usable records: analysed, with a weakness and a reference; urls are distinct in their order."""
    out = raw.where(F.col("vulnStatus").isin(KEPT_STATUS) & F.col("weaknesses").isNotNull())
    out = out.select(
        F.col("id").alias("cve_id"), english_description(F.col("descriptions")).alias("description"), F.col("published").alias("publish_date"), F.col("lastModified").alias("last_modify_date"),
        cvss(F.col("metrics")).alias("cvss"), cwe_ids(F.col("weaknesses")).alias("cwe_ids"), F.array_distinct(F.transform("references", lambda r: r["url"])).alias("urls"),
    )
    return out.where((F.size("cwe_ids") > 0) & (F.size("urls") > 0))
