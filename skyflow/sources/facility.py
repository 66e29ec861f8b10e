"""Target lists dumped from the facility's API as JSON: a list, one target, or pages with results and next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

TARGET = (
    "id bigint, uploadedfor_survey_id int, name string, ra double, dec double, subsurvey string, mag double, "
    "mag_type string, is_active boolean, date_submitted string, date_modified string, date_ingested string, "
    "ostd_targ_id bigint, ostd_u_obj_id bigint"
)


def _targets(body: Column) -> Column:
    text = F.trim(body)
    page = F.from_json(text, f"struct<results:array<struct<{_as_struct()}>>,next:string>")
    single = F.from_json(text, f"struct<{_as_struct()}>")
    return (
        F.when(text.startswith("["), F.from_json(text, f"array<struct<{_as_struct()}>>"))
        .when(page["results"].isNotNull(), page["results"])
        .otherwise(F.array(single))
    )


def _as_struct() -> str:
    return ",".join(":".join(part.strip().split(" ")) for part in TARGET.split(","))


def flatten_targets(pages: DataFrame, body: str = "body") -> DataFrame:
    """One row per target of each answer; a page inside a one-element list is opened too."""
    text = F.trim(F.col(body))
    wrapped = F.from_json(text, "array<struct<results:string>>")
    inner = F.when(
        text.startswith("[") & (F.size(wrapped) == 1) & wrapped[0]["results"].isNotNull(), wrapped[0]["results"]
    ).otherwise(text)
    rest = [c for c in pages.columns if c != body]
    rows = pages.select(*rest, F.explode(_targets(inner)).alias("_t"))
    return rows.select(*rest, "_t.*")
