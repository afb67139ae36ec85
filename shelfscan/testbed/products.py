"""Products derived in Spark: one per row of ``orders``, tags from its line items.

``oracle.PRODUCTS`` states the same derivation in SQL.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

#: First word of a part's name to label tag; the last three are no health claims.
LABELS = {
    "small": "en:organic",
    "hot": "en:no-sugar",
    "large": "en:vegan",
    "cold": "en:gluten-free",
    "new": "en:high-protein",
    "red": "en:made-in-brazil",
    "blue": "pt:sem-lactose",
    "old": "en:green-dot",
}

#: Second word of a part's name to category tag; the last one is in no group.
CATEGORIES = {
    "widget": "en:yogurts",
    "gear": "en:biscuits",
    "plate": "en:sodas",
    "bolt": "en:breads",
    "rod": "en:sausages",
    "ring": "en:cookies",
    "gizmo": "en:desserts",
    "anvil": "en:unmapped-things",
}

#: Moves order dates by 25 years, into the window the reports look at.
SHIFT_SECONDS = 788918400


def _case(subject: str, values: Iterable[str]) -> str:
    """Simple CASE giving the value at a position that counts from 0."""
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {subject} {whens} END"


def _bit(word: str, vocabulary: dict[str, str]) -> str:
    """The word's own bit; 0 for a word that is not in the vocabulary."""
    whens = " ".join(f"WHEN '{known}' THEN {1 << i}" for i, known in enumerate(vocabulary))
    return f"CASE {word} {whens} ELSE 0 END"


def _tags_of(mask: str, vocabulary: dict[str, str]) -> str:
    """Sorted tags of the bits set in a mask."""
    tags = sorted((tag, 1 << i) for i, tag in enumerate(vocabulary.values()))
    present = ", ".join(f"CASE WHEN {mask} & {bit} <> 0 THEN '{tag}' END" for tag, bit in tags)
    return f"array_compact(array({present}))"


def _order_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags per order: bit masks for labels and categories, a set of numbers for additives.

    They stay that small until the order's shuffle is done. Joining part is left
    to Spark: broadcast below the limit, else a sort-merge join in which the
    adaptive skew join splits a hot part.
    """
    part = spark.read.parquet(f"{sf_dir}/part.parquet").selectExpr(
        "p_partkey AS l_partkey",
        _bit("split_part(p_name, ' ', 1)", LABELS) + " AS label_bit",
        _bit("split_part(p_name, ' ', 2)", CATEGORIES) + " AS category_bit",
    )
    lines = (
        spark.read.parquet(f"{sf_dir}/lineitem.parquet")
        .filter("l_discount > 0.02D")
        .selectExpr(
            "l_orderkey",
            "l_partkey",
            "CAST(l_suppkey % 100 * 3 + l_linenumber % 3 AS INT) AS additive",
        )
    )
    return (
        lines.join(part, "l_partkey")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            F.bit_or("label_bit").alias("label_mask"),
            F.bit_or("category_bit").alias("category_mask"),
            F.collect_set("additive").alias("additives"),
        )
    )


_ADDITIVE = "concat('en:e', 400 + n DIV 3, " + _case("n % 3", ["i", "ii", ""]) + ")"
_NAME = "concat(" + _case(
    "o_orderkey % 4", ["Leite Integral ", "LEITE Semi Integral ", "Pão ", "Biscoito "]
) + ", o_orderkey)"
_NO_TEXTS = "CAST(array() AS ARRAY<STRUCT<lang: STRING, text: STRING>>)"
_CREATED = f"CAST(unix_date(CAST(o_orderdate AS DATE)) AS BIGINT) * 86400 + {SHIFT_SECONDS}"


def _texts(text: str) -> str:
    return f"array(named_struct('lang', 'pt', 'text', {text}))"


#: Source column to the expression that derives it from an order and its tags.
_COLUMNS = {
    "code": "concat(" + _case("o_orderkey % 3", ["789", "790", "400"]) + ", lpad(o_orderkey, 10, '0'))",
    "product_name": f"""CASE WHEN o_orderkey % 97 = 0 THEN {_NO_TEXTS}
        WHEN o_orderkey % 89 = 0 THEN {_texts("CAST(NULL AS STRING)")} ELSE {_texts(_NAME)} END""",
    "nova_group": """CAST(CASE WHEN o_orderstatus = 'F' THEN 4
        WHEN o_orderstatus = 'O' THEN 1 + o_orderkey % 3
        WHEN o_orderstatus = 'P' AND o_orderkey % 10 <> 0 THEN 4 END AS INT)""",
    "nutriscore_grade": """CASE o_orderpriority WHEN '1-URGENT' THEN 'A' WHEN '2-HIGH' THEN 'b'
        WHEN '3-MEDIUM' THEN if(o_orderstatus = 'O', 'd', 'c')
        WHEN '4-NOT SPECIFIED' THEN 'unknown' WHEN '5-LOW' THEN 'e' END""",
    "labels_tags": _tags_of("label_mask", LABELS),
    "brands": "CASE WHEN o_orderkey % 50 = 0 THEN NULL WHEN o_orderkey % 51 = 0 THEN '' ELSE concat("
    + _case("o_orderkey % 3", ["Café ", "CAFE ", " cafe "])
    + ", o_custkey % 40) END",
    "categories": _case("o_custkey % 3", ["Laticínios, Leites", "LATICÍNIOS", "Padaria, pão"]),
    "categories_tags": _tags_of("category_mask", CATEGORIES),
    "additives_tags": f"array_sort(transform(coalesce(additives, CAST(array() AS ARRAY<INT>)), n -> {_ADDITIVE}))",
    "additives_n": "if(o_orderkey % 7 <> 0, coalesce(size(additives), 0), NULL)",
    "ingredients_text": f"""if(o_orderkey % 5 = 0, {_NO_TEXTS},
        {_texts("concat('ingredientes ', o_custkey)")})""",
    "ingredients_n": "if(o_custkey % 11 <> 0, CAST(o_custkey % 30 AS INT), NULL)",
    "created_t": _CREATED,
    "last_modified_t": f"{_CREATED} + o_custkey % 1000 * 86400",
}


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue in the source schema."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    tagged = orders.join(_order_tags(spark, sf_dir), "o_orderkey", "left")
    return tagged.selectExpr(*[f"{derived} AS {name}" for name, derived in _COLUMNS.items()])


def product_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later export of the same catalogue.

    Every product comes again with another grade and a stamp up to three days
    older or newer than, or equal to, the first one; a fifth come as new codes.
    """
    number = "CAST(substring(code, 4) AS BIGINT)"
    changed = {
        "code": f"if({number} % 5 = 0, concat('791', substring(code, 4)), code)",
        "nutriscore_grade": "if(nutriscore_grade = 'A', 'b', 'a')",
        "last_modified_t": f"last_modified_t + ({number} % 7 - 3) * 86400",
    }
    return products(spark, sf_dir).selectExpr(
        *[f"{changed.get(name, name)} AS {name}" for name in _COLUMNS]
    )
