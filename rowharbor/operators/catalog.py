"""Catalogue metadata: batch updates, current values, and licences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowharbor.operators.publish import last_by_key

NO_LICENSE_LABEL = "-- No License --"
NO_LICENSE_ID = ""

# Licences a dataset can carry, id and label.
LICENSES = (
    ("PUBLIC_DOMAIN", "Public Domain"),
    ("USGOV_WORKS", "Public Domain U.S. Government"),
    ("CC_30_BY", "Creative Commons Attribution 3.0 Unported"),
    ("OGL_CANADA", "Canada Open Government Licence"),
    ("CC_40_BY_ND", "Creative Commons Attribution | NoDerivatives 4.0 International License"),
    ("CC_30_BY_NC_ND_IGO", "Creative Commons Attribution | Noncommercial | No Derivative Works 3.0 IGO"),
    ("SEE_TERMS_OF_USE", "See Terms of Use"),
    ("NIST_SRD", "National Institute of Standards and Technology Licensing"),
    ("IODL", "Italian Open Data License 2.0"),
    ("NBOGL", "New Brunswick Open Government Licence"),
    ("CC_30_BY_AUS", "Creative Commons Attribution 3.0 Australia"),
    ("PDDL", "Open Data Commons Public Domain Dedication and License"),
    ("OSODL", "OS Open Data Licence"),
    ("UK_OGLV3.0", "UK Open Government Licence v3"),
    ("CC0_10", "Creative Commons 1.0 Universal (Public Domain Dedication)"),
    ("CC_30_BY_SA", "Creative Commons Attribution | Share Alike 3.0 Unported"),
    ("CC_30_BY_ND", "Creative Commons Attribution | No Derivative Works 3.0 Unported"),
    ("CC_30_BY_NC", "Creative Commons Attribution | Noncommercial 3.0 Unported"),
    ("CC_30_BY_NC_SA", "Creative Commons Attribution | Noncommercial | Share Alike 3.0 Unported"),
    ("CC_30_BY_NC_ND", "Creative Commons Attribution | Noncommercial | No Derivative Works 3.0 Unported"),
    ("CC_40_BY", "Creative Commons Attribution 4.0 International"),
    ("CC_40_BY_SA", "Creative Commons Attribution | Share Alike 4.0 International"),
    ("ODBL", "Open Data Commons Open Database License"),
    ("ODC_BY", "Open Data Commons Attribution License"),
    ("OPEN_DATABASE_LICENSE", "Open Database License"),
    ("CC_30_BY_IGO", "Creative Commons Attribution 3.0 IGO"),
    ("CC_30_BY_NZ", "Creative Commons Attribution 3.0 New Zealand"),
    ("CC_30_BY_NC_NZ", "Creative Commons Attribution | Noncommercial 3.0 New Zealand"),
    ("CC_30_BY_NC_SA_NZ", "Creative Commons Attribution | Noncommercial | Share Alike 3.0 New Zealand"),
    ("OGL_NOVA_SCOTIA", "Nova Scotia Open Government Licence"),
    ("OGL-PEI", "Open Government Licence - Prince Edward Island"),
)


def licenses(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(LICENSES), "license_id string, label string")


def license_list(known: DataFrame) -> DataFrame:
    """Licences by label, "no licence" first, with their ``place`` in the list from 1."""
    none = known.sparkSession.createDataFrame(
        [(NO_LICENSE_ID, NO_LICENSE_LABEL)], "license_id string, label string"
    )
    listed = none.withColumn("_last", F.lit(0)).unionByName(known.withColumn("_last", F.lit(1)))
    by = Window.orderBy("_last", "label")  # a fixed list of some dozens
    return listed.withColumn("place", F.row_number().over(by)).orderBy("place").drop("_last")


def lookup_license(df: DataFrame, known: DataFrame, code: Column, by: str = "license_id") -> DataFrame:
    """Add ``license_id`` and ``license_label`` for a code or a label; "no licence" for any other.
    Codes are unique in ``known``, so no row is multiplied."""
    found = known.select(
        F.col(by).alias("_code"), F.col("license_id"), F.col("label").alias("license_label")
    ).dropDuplicates(["_code"])
    joined = df.withColumn("_wanted", code).join(found, F.col("_wanted") == F.col("_code"), "left")
    return joined.drop("_wanted", "_code").withColumns(
        {
            "license_id": F.coalesce("license_id", F.lit(NO_LICENSE_ID)),
            "license_label": F.coalesce("license_label", F.lit(NO_LICENSE_LABEL)),
        }
    )


# catalogue column <- column of an update record
_OVERWRITTEN = {
    "title": "title",
    "description": "description",
    "category": "category",
    "tags": "keywords",
    "license_id": "license_id",
    "attribution": "data_provided_by",
    "attribution_link": "source_link",
}


def update_metadata(
    catalog: DataFrame, updates: DataFrame, order: Column | None = None
) -> DataFrame:
    """The catalogue after all updates. A record overwrites every field, with nulls too; missing
    tags become an empty list, and a record without a licence leaves the licence alone. The
    contact goes into the ``private`` map. Of several updates of a dataset the last by ``order``
    counts, or the last as they are read."""
    at = F.monotonically_increasing_id() if order is None else order
    new = last_update(updates.withColumn("_order", at), F.col("_order")).select(
        "dataset_id",
        *[F.col(u).alias(f"_new_{c}") for c, u in _OVERWRITTEN.items()],
        F.col("contact_info").alias("_contact"),
        F.lit(True).alias("_in"),
    )
    joined = catalog.join(new, "dataset_id", "left")

    def value(c: str) -> Column:
        if c in _OVERWRITTEN:
            fresh = F.col(f"_new_{c}")
            if c == "tags":
                fresh = F.coalesce(fresh, F.array().cast("array<string>"))
            if c == "license_id":
                fresh = F.coalesce(fresh, F.col(c))
            return F.when(F.col("_in"), fresh).otherwise(F.col(c)).alias(c)
        if c == "private":
            contact = F.create_map(F.lit("contactEmail"), F.col("_contact"))
            others = F.map_filter(
                F.coalesce(F.col(c), F.create_map().cast("map<string,string>")),
                lambda k, v: k != "contactEmail",
            )
            return F.when(F.col("_in"), F.map_concat(others, contact)).otherwise(F.col(c)).alias(c)
        return F.col(c)

    return joined.select(*[value(c) for c in catalog.columns])


def unknown_datasets(catalog: DataFrame, updates: DataFrame) -> DataFrame:
    """Updates of datasets that do not exist."""
    return updates.join(catalog.select("dataset_id"), "dataset_id", "left_anti").select(
        "dataset_id",
        F.lit("PUBLISH_ERROR").alias("status"),
        F.lit("No dataset has this id, or publishing to it is not allowed")
        .alias("message"),
    )


def last_update(updates: DataFrame, order: Column) -> DataFrame:
    return last_by_key(updates, "dataset_id", order)


def read_metadata(catalog: DataFrame) -> DataFrame:
    """Current catalogue values in the shape of an update record."""
    return catalog.select(
        "dataset_id",
        *[F.col(c).alias(u) for c, u in _OVERWRITTEN.items()],
        F.try_element_at("private", F.lit("contactEmail")).alias("contact_info"),
    )
