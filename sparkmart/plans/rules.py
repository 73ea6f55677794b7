"""Row counts per cleaning rule.

Each family of rules is a set of aggregates (``*_counts``) over the table that the flow writes, and a report made of their values. The
flow lets the write itself compute them; over a stored table they are one aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart import fixed_values as fv
from sparkmart.functions.numbers import number, percent
from sparkmart.plans.orders import REJECTED

COLUMNS = ["regle", "entite", "avant", "apres", "supprimees", "pct", "remplacees"]


def _report(counts: DataFrame, entity: str, rules: list[tuple[str, Column, Column, Column]]) -> DataFrame:
    """(rule, rows before, rows after, values replaced) per rule, from a one-row DataFrame of counts."""
    structs = [
        F.struct(
            F.lit(rule).alias("regle"),
            F.lit(entity).alias("entite"),
            before.cast("bigint").alias("avant"),
            after.cast("bigint").alias("apres"),
            replaced.cast("bigint").alias("remplacees"),
        )
        for rule, before, after, replaced in rules
    ]
    rows = counts.select(F.inline(F.array(*structs)))
    removed = F.col("avant") - F.col("apres")
    pct = F.coalesce(percent(removed, F.col("avant"), 2), F.lit(0.0))
    return rows.withColumn("supprimees", removed).withColumn("pct", pct).select(*COLUMNS)


def _one_row(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """Counts that are known already."""
    return spark.range(1).select(*[F.lit(int(value or 0)).cast("bigint").alias(name) for name, value in counts.items()])


def _same(rule: str, before: str, replaced: str) -> tuple[str, Column, Column, Column]:
    return rule, F.col(before), F.col(before), F.col(replaced)


def order_counts() -> dict[str, Column]:
    """Aggregates over the flagged orders."""
    rejected = lambda rule: F.count_if(F.col(REJECTED) == rule)
    kept = F.col(REJECTED).isNull()
    dated = ~F.coalesce(F.col(REJECTED) == "date", F.lit(False))
    return {
        "uniques": F.count(F.lit(1)),
        "sans_date": rejected("date"),
        "sans_quantite": rejected("quantite"),
        "sans_prix": rejected("prix"),
        "villes": F.count_if(dated & (F.col("ville_livraison") == fv.UNKNOWN_CITY)),
        "statuts": F.count_if(dated & ~F.col("_statut_brut").eqNullSafe(F.col("statut"))),
        "livreurs": F.count_if(kept & F.col("_livreur_manquant")),
        "delais": F.count_if(kept & F.col("_delai_negatif")),
    }


def order_report(counts: DataFrame) -> DataFrame:
    """From one row of ``order_counts`` and ``extraites``."""
    c, none = F.col, F.lit(0)
    dated_rows = c("uniques") - c("sans_date")
    quantified = dated_rows - c("sans_quantite")
    priced = quantified - c("sans_prix")
    return _report(
        counts,
        "commandes",
        [
            ("R1 doublons id_commande", c("extraites"), c("uniques"), none),
            ("R2 dates", c("uniques"), dated_rows, none),
            ("R3 villes", dated_rows, dated_rows, c("villes")),
            ("R4 statuts", dated_rows, dated_rows, c("statuts")),
            ("R5 quantites invalides", dated_rows, quantified, none),
            ("R6 prix nuls", quantified, priced, none),
            ("R7 livreurs manquants", priced, priced, c("livreurs")),
            ("R9 delais negatifs", priced, priced, c("delais")),
        ],
    )


def order_rules(raw: DataFrame, flagged: DataFrame) -> DataFrame:
    """Rule metrics of the orders from the raw extract and the flagged table."""
    extracted = raw.agg(F.count(F.lit(1)).alias("extraites"))
    return order_report(flagged.agg(*_named(order_counts())).withColumn("extraites", extracted.scalar()))


def _named(counts: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in counts.items()]


def client_counts() -> dict[str, Column]:
    """Aggregates over the cleaned clients. Rejected values are null there."""
    return {
        "uniques": F.count(F.lit(1)),
        "sexes": F.count_if(F.col("sexe") == fv.UNKNOWN_SEX),
        "ages": F.count_if(F.col("age").isNull()),
        "emails": F.count_if(F.col("email").isNull()),
        "villes": F.count_if(F.col("ville") == fv.UNKNOWN_CITY),
    }


def client_report(counts: DataFrame) -> DataFrame:
    rules = [("R2 sexe inconnu", "sexes"), ("R3 ages invalides", "ages"), ("R5 emails invalides", "emails"), ("R6 villes inconnues", "villes")]
    first = ("R1 doublons email", F.col("extraits"), F.col("uniques"), F.lit(0))
    return _report(counts, "clients", [first, *[_same(rule, "uniques", column) for rule, column in rules]])


def client_rules(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    extracted = raw.agg(F.count(F.lit(1)).alias("n"))
    return client_report(cleaned.agg(*_named(client_counts())).withColumn("extraits", extracted.scalar()))


def product_raw_counts(categories: dict[str, str] = fv.CATEGORIES) -> dict[str, Column]:
    """Aggregates over the products as they were read."""
    return {
        "n": F.count(F.lit(1)),
        "categories": F.count_if(~F.col("categorie").isin(*sorted(set(categories.values())))),
        "prix": F.count_if(number(F.col("prix_catalogue")).isNull()),
    }


def product_counts() -> dict[str, Column]:
    """Aggregates over the cleaned products."""
    return {"inactifs": F.count_if(~F.col("actif"))}


def product_report(counts: DataFrame) -> DataFrame:
    rules = [("R1 categories", "categories"), ("R2 prix null", "prix"), ("R4 produits inactifs", "inactifs")]
    return _report(counts, "produits", [_same(rule, "n", column) for rule, column in rules])


def product_rules(raw: DataFrame, cleaned: DataFrame, categories: dict[str, str] = fv.CATEGORIES) -> DataFrame:
    counts = raw.agg(*_named(product_raw_counts(categories)))
    return product_report(counts.withColumn("inactifs", cleaned.agg(*_named(product_counts())).scalar()))


def fact_report(counts: DataFrame) -> DataFrame:
    """From one row of ``lignes`` and ``faits``."""
    return _report(counts, "faits", [("fait_ventes", F.col("lignes"), F.col("faits"), F.lit(0))])


def fact_rule(orders: DataFrame, fact: DataFrame) -> DataFrame:
    counts = fact.agg(F.count(F.lit(1)).alias("faits")).withColumn("lignes", orders.agg(F.count(F.lit(1))).scalar())
    return fact_report(counts)


def report_of(spark: SparkSession, orders: dict, clients: dict, products: dict, fact: dict) -> DataFrame:
    """The report of all four families from counts that the writes have made."""
    return (
        order_report(_one_row(spark, orders))
        .unionByName(client_report(_one_row(spark, clients)))
        .unionByName(product_report(_one_row(spark, products)))
        .unionByName(fact_report(_one_row(spark, fact)))
    )


def markdown(report: DataFrame) -> str:
    """The report as a Markdown table (one line per rule, about twenty in all)."""
    lines = [
        "# Rapport des transformations",
        "",
        "| Règle | Entité | Avant | Après | Supprimées | % | Remplacées |",
        "|---|---|--:|--:|--:|--:|--:|",
    ]
    for row in report.select(*COLUMNS).collect():
        lines.append("| " + " | ".join(str(value) for value in row) + " |")
    return "\n".join(lines)
