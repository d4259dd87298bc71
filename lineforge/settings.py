"""Everything the pipeline takes as a parameter rather than as code."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Columns that carry no information and leave after profiling.
JUNK_COLUMNS = (
    "customer_email",
    "customer_password",
    "product_description",
    "product_status",
    "product_image",
)

# Audit columns that ingest adds.
AUDIT_COLUMNS = ("_malformed", "_ingested_at", "_source_file")

# The attributes of the dimensions, natural keys first.
PRODUCT_COLUMNS = (
    "product_card_id",
    "product_name",
    "category_id",
    "category_name",
    "department_id",
    "department_name",
    "product_price",
)
GEO_COLUMNS = ("market", "order_region", "order_country", "order_state", "order_city")
CUSTOMER_COLUMNS = (
    "customer_id",
    "customer_fname",
    "customer_lname",
    "customer_segment",
    "customer_city",
    "customer_state",
    "customer_country",
    "customer_zipcode",
)


@dataclass(frozen=True)
class History:
    """How the simulated customer history is cut into versions.

    A customer whose id divides by ``modulus``, and whose segment is not ``base_value`` now,
    had that segment from ``floor`` to the day before ``cutoff``.
    """

    # Fixed values for the public order-line source file.
    base_value: str = "Consumer"
    modulus: int = 20
    floor: str = "2000-01-01"
    cutoff: str = "2017-06-01"
    far: str = "9999-12-31"


@dataclass(frozen=True)
class Settings:
    """Parameters of one pipeline; the defaults fit the public order-line source file.

    ``tie_break`` orders the copies of one order line; the first one survives. Copies that
    agree on all of it are ordered by the rest of their columns, so the survivor never
    depends on how the rows were read. ``schema`` casts a bronze of texts on the way to silver.
    ``null_safe_geo`` lets a place with null parts find its key in the fact.
    """

    drop: tuple[str, ...] = JUNK_COLUMNS + AUDIT_COLUMNS
    date_format: str = "M/d/yyyy H:mm"
    grain: str = "order_item_id"
    tie_break: tuple[str, ...] = ()
    helpers: tuple[str, ...] = ()
    history: History = field(default_factory=History)
    schema: T.StructType | None = None
    null_safe_geo: bool = False
