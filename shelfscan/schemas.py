"""Declared schemas. Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

_texts = T.ArrayType(
    T.StructType([T.StructField("lang", T.StringType()), T.StructField("text", T.StringType())])
)
_tags = T.ArrayType(T.StringType())


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


#: The nested export the products are read from.
SOURCE = _struct(
    code=T.StringType(),
    product_name=_texts,
    nova_group=T.IntegerType(),
    nutriscore_grade=T.StringType(),
    labels_tags=_tags,
    brands=T.StringType(),
    categories=T.StringType(),
    categories_tags=_tags,
    additives_tags=_tags,
    additives_n=T.IntegerType(),
    ingredients_text=_texts,
    ingredients_n=T.IntegerType(),
    created_t=T.LongType(),
    last_modified_t=T.LongType(),
)

#: The export flattened: one text per product, tag columns stay arrays.
RAW = T.StructType(
    [
        T.StructField(f.name, T.StringType() if f.dataType == _texts else f.dataType)
        for f in SOURCE
    ]
)

TAG_COLUMNS = ("labels_tags", "categories_tags", "additives_tags")

STAGING = _struct(
    product_id=T.StringType(),
    product_name=T.StringType(),
    nova_group=T.IntegerType(),
    nutriscore_grade=T.StringType(),
    nutriscore_numeric=T.IntegerType(),
    brands=T.StringType(),
    categories=T.StringType(),
    labels_tags=_tags,
    categories_tags=_tags,
    additives_tags=_tags,
    additives_n=T.IntegerType(),
    additives_count=T.IntegerType(),
    ingredients_text=T.StringType(),
    ingredients_n=T.IntegerType(),
    created_at=T.TimestampType(),
    created_date=T.DateType(),
    created_year=T.IntegerType(),
    matched_health_claims=_tags,
    is_ultra_processed=T.BooleanType(),
    is_nutriscore_a_but_nova4=T.BooleanType(),
    has_health_claim=T.BooleanType(),
    is_deceptive=T.BooleanType(),
)

MART = _struct(
    category_tag=T.StringType(),
    products_with_claim=T.LongType(),
    deceptive_products=T.LongType(),
    deceptive_share=T.DoubleType(),
)

CATEGORY_COUNTS = _struct(
    category_tag=T.StringType(),
    products_with_claim=T.LongType(),
    deceptive_products=T.LongType(),
)

HEALTH_CLAIMS = _struct(claim_tag=T.StringType(), claim_family=T.StringType())
CATEGORY_GROUPS = _struct(tag=T.StringType(), grp=T.StringType())
ADDITIVE_FAMILIES = _struct(code=T.StringType(), category=T.StringType())
ADDITIVE_REFS = _struct(
    ord=T.IntegerType(), category=T.StringType(), concern=T.StringType(), url=T.StringType()
)

#: One row per finished load; the highest version of a name is its state.
LOAD_STATE = _struct(
    name=T.StringType(),
    version=T.LongType(),
    cursor=T.LongType(),
    slot=T.StringType(),
    buckets=T.IntegerType(),
    parts=_tags,
    stream=T.StringType(),
    batch=T.LongType(),
)

#: One row per file that a load has taken.
LEDGER = _struct(load=T.StringType(), file=T.StringType(), length=T.LongType())
