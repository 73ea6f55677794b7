"""Reference tables: city variants and the skill dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart import fixed_values as fv
from sparkmart import schemas
from sparkmart.functions.text import strip
from sparkmart.sources.files import ORDINAL, check_source


def city_variants(regions: DataFrame, fixed: dict[str, str] = fv.CITY_VARIANTS, order_by: str | None = None) -> DataFrame:
    """(variant, city): each region's code, name and name without accents, and the fixed list.

    The fixed list wins over the regions; between regions the one that is last
    by ``order_by`` wins: by default the place in the source where it is known, else
    the code.  One row per variant, so a lookup cannot multiply rows.
    """
    order_by = order_by or (ORDINAL if ORDINAL in regions.columns else "code_ville")
    name = strip(F.lower("nom_ville_standard"))
    spellings = F.array(strip(F.lower("code_ville")), name, F.translate(name, fv.CITY_ACCENTS, fv.CITY_ACCENTS_PLAIN))
    derived = regions.select(
        F.explode(spellings).alias("variant"), F.col("nom_ville_standard").alias("city"), F.col(order_by).alias("o")
    )
    from_regions = derived.groupBy("variant").agg(F.max_by("city", F.struct("o", "city")).alias("city"))
    listed = fixed_cities(regions.sparkSession, fixed)
    return (
        from_regions.filter(F.col("variant").isNotNull() & ~F.col("variant").isin(list(fixed))).unionByName(listed)
    )


def fixed_cities(spark: SparkSession, fixed: dict[str, str]) -> DataFrame:
    """The list as literal rows, so that Spark knows how small it is and can broadcast what it is joined to."""
    quote = lambda text: "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
    rows = ", ".join(f"({quote(variant)}, {quote(city)})" for variant, city in fixed.items())
    return spark.sql(f"SELECT variant, city FROM VALUES {rows} AS listed(variant, city)")


def read_skills(spark: SparkSession, path: str) -> DataFrame:
    """(alias, competence, famille) of the nested skill dictionary; a later duplicate alias wins."""
    check_source(spark, path)
    families = spark.read.schema(schemas.SKILLS).json(path, multiLine=True)
    return flatten_skills(families)


def flatten_skills(families: DataFrame) -> DataFrame:
    per_family = families.select(F.posexplode("familles").alias("i", "famille", "skills"))
    per_skill = per_family.select("i", "famille", F.posexplode("skills").alias("j", "competence", "aliases"))
    per_alias = per_skill.select("famille", "competence", F.posexplode("aliases").alias("k", "alias"), "i", "j")
    latest = F.max_by(F.struct("competence", "famille"), F.struct("i", "j", "k")).alias("s")
    return per_alias.groupBy(F.lower("alias").alias("alias")).agg(latest).select("alias", "s.competence", "s.famille")
