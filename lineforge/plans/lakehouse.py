"""The layered lakehouse: every table is built from the layer below, written, and read back.

Writing cuts the lineage once per table, so the costly steps (reading and deduplicating the
raw lines, the six lookups) run once, not once per report, and a lost executor costs a
re-read of files. It also gives each dimension a counted size for the join that uses it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from functools import partial
from threading import RLock
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lineforge.operators import (
    build_date_dimension,
    build_dimension,
    dense_key,
    extend_keys,
    latest_per_key,
    scd2_simulated,
    stable_key,
)
from lineforge.plans.fact import build_fact
from lineforge.plans.kpi import delivery_kpi, segment_kpi
from lineforge.plans.silver import OUTCOME, clean_orders, rejected_orders, sort_orders, sorted_clean, sorted_rejected
from lineforge.settings import CUSTOMER_COLUMNS, GEO_COLUMNS, PRODUCT_COLUMNS, Settings
from lineforge.sinks import create_layers, export_csv, write_counted
from lineforge.sources import FILE_SCHEMA, ingest_csv
from lineforge.storage import fit_shuffle, scratch

DIMENSIONS = ("dim_customer", "dim_product", "dim_geo", "dim_shipping_mode", "dim_date")

# The kept reports, and the column that each is exported by, largest first.
KPI_ORDER = {"kpi_delivery_by_market": "total_orders", "kpi_sales_by_segment": "total_sales"}
KPIS = tuple(KPI_ORDER)
GOLD_TABLES = ("fact_order_line", *DIMENSIONS, *KPIS)

# Written before any other, since all else is built from it.
FIRST_TABLE = "bronze.order_lines"

# Raw lines by outcome, from which both tables of silver are read; gone once a build is shown.
SORTED_TABLE = "silver.sorted_lines"

# Tables that ``buckets`` deals alike, and by what: those of the one join whose sides may both be large.
BUCKETED = {"silver.order_lines": "customer_id", "gold.dim_customer": "customer_id"}

# Natural key and number of the dimensions that are numbered.
NUMBERED = {
    "dim_product": (("product_card_id",), "product_key"),
    "dim_geo": (GEO_COLUMNS, "geo_key"),
    "dim_shipping_mode": (("shipping_mode",), "shipping_mode_key"),
    "dim_customer": (("customer_id", "start_date"), "customer_key"),
}

# Tables of one step need none of each other.
STEPS = (
    (FIRST_TABLE,),
    (SORTED_TABLE,),
    ("silver.order_lines", "silver.rejected_lines"),
    tuple(f"gold.{name}" for name in DIMENSIONS),
    ("gold.fact_order_line",),
    tuple(f"gold.{name}" for name in KPIS),
)


# With keys that stay, what the next build is to know, by dimension.
KEY_STEP = tuple(f"gold.keys_of_{name}" for name in NUMBERED)

# Parts the name of a stored table from the build that it belongs to.
BUILD_MARK = "__"


def _new_suffix() -> str:
    return f"{BUILD_MARK}{uuid4().hex[:12]}"


def latest_customers(silver: DataFrame, grain: str) -> DataFrame:
    """Customer attributes as of each customer's latest order line; ``silver`` is a stored table or some of its rows."""
    lines = silver.select(*CUSTOMER_COLUMNS, "order_ts", grain)
    return latest_per_key(lines, ["customer_id"], "order_ts", grain, stored=True).select(*CUSTOMER_COLUMNS)


Number = Callable[[DataFrame, Sequence[str], str], DataFrame]


def product_dimension(silver: DataFrame, grain: str, number: Number = dense_key) -> DataFrame:
    return build_dimension(
        silver, PRODUCT_COLUMNS, ["product_card_id"], "product_key", tie_break=grain, number=number
    )


def geo_dimension(silver: DataFrame, number: Number = dense_key) -> DataFrame:
    return build_dimension(silver, GEO_COLUMNS, GEO_COLUMNS, "geo_key", number=number)


def shipping_dimension(silver: DataFrame, number: Number = dense_key) -> DataFrame:
    return build_dimension(silver, ["shipping_mode"], ["shipping_mode"], "shipping_mode_key", number=number)


def date_dimension(silver: DataFrame) -> DataFrame:
    return build_date_dimension(silver, ["order_date"], ["order_date", "ship_date"])


def customer_dimension(silver: DataFrame, settings: Settings, number: Number = dense_key) -> DataFrame:
    return scd2_simulated(
        latest_customers(silver, settings.grain),
        "customer_id",
        "customer_segment",
        settings.history,
        "customer_key",
        number,
    )


class Lakehouse:
    """Tables of one source, each built on first use and kept.

    ``source`` gives the raw lines whenever bronze is built. ``prefix`` names the schemas
    ``<prefix>_bronze``, ``_silver`` and ``_gold``, plain layer names if it is empty. The tables
    are a snapshot, stored under names of their own; ``refresh`` begins another one. ``build``
    makes every table and then lets one view, ``current_build``, name that build, and the plain names,
    which are views as well, show it; until then they show the one before, and so they do if a build
    fails. ``open`` reads the build that is named, so the keys of a stored fact never meet a dimension
    of another build. With ``keep_keys``
    a natural key that any build under ``prefix`` has numbered keeps its number; without, every build
    numbers from 1 in the order of natural keys. ``buckets`` stores the lines and the customers dealt
    by customer into that many files, so that they join without a shuffle; leave it out where a few
    customers have a large share of the lines, whose bucket one task would read.
    """

    def __init__(
        self,
        spark: SparkSession,
        source: Callable[[], DataFrame],
        prefix: str,
        settings: Settings | None = None,
        location: str | None = None,
        keep_keys: bool = False,
        buckets: int = 0,
    ) -> None:
        self.spark = spark
        self._buckets = buckets
        self._steps = (*STEPS, KEY_STEP) if keep_keys else STEPS
        self.settings = settings or Settings()
        before = f"{prefix}_" if prefix else ""
        self.schemas = {layer: f"{before}{layer}" for layer in ("bronze", "silver", "gold")}
        self.counts: dict[str, int] = {}
        self._opened = False
        self._suffix = _new_suffix()
        self._builders: dict[str, Callable[[], DataFrame]] = {
            "bronze.order_lines": source,
            SORTED_TABLE: lambda: sort_orders(self.bronze(), self.settings),
            "silver.order_lines": self._clean,
            "silver.rejected_lines": self._rejected,
            "gold.dim_product": lambda: product_dimension(
                self.silver(), self.settings.grain, self._number("dim_product")
            ),
            "gold.dim_geo": lambda: geo_dimension(self.silver(), self._number("dim_geo")),
            "gold.dim_shipping_mode": lambda: shipping_dimension(
                self.silver(), self._number("dim_shipping_mode")
            ),
            "gold.dim_date": lambda: date_dimension(self.silver()),
            "gold.dim_customer": lambda: customer_dimension(
                self.silver(), self.settings, self._number("dim_customer")
            ),
            "gold.fact_order_line": self.plan_fact,
            "gold.kpi_delivery_by_market": lambda: delivery_kpi(self.fact(), self.gold("dim_geo")),
            "gold.kpi_sales_by_segment": lambda: segment_kpi(
                self.fact(), self.gold("dim_customer")
            ),
        }
        for name in NUMBERED if keep_keys else ():
            self._builders[f"gold.keys_of_{name}"] = partial(self._keys_after, name)
        self._locks = {table: RLock() for table in self._builders}
        self._location = location

    @classmethod
    def open(cls, spark: SparkSession, prefix: str, settings: Settings | None = None) -> Lakehouse:
        """The last build under ``prefix``; nothing is built.

        Which one that is is read once, from one view, so all tables are of one build, also while
        another one is being shown.
        """

        def nothing() -> DataFrame:
            raise ValueError("an opened lakehouse has no source to build from")

        opened = cls(spark, nothing, prefix, settings)
        shown = spark.table(opened._pointer()).first() if spark.catalog.tableExists(opened._pointer()) else None
        if shown is None:
            raise ValueError(f"no build to open, missing {opened._pointer()}")
        opened._suffix = shown.suffix
        missing = [table for table in opened._shown() if not spark.catalog.tableExists(opened.name(table))]
        if missing:
            raise ValueError(f"no build to open, missing {', '.join(missing)}")
        opened._opened = True
        return opened

    @classmethod
    def from_csv(
        cls,
        spark: SparkSession,
        path: str,
        prefix: str,
        schema: T.StructType = FILE_SCHEMA,
        encoding: str = "ISO-8859-1",
        infer: bool = False,
        multiline: bool = False,
        **options,
    ) -> Lakehouse:
        """Over delimited files, as they come from the source system; reader options as for ``ingest_csv``.

        Bronze keeps the texts; silver has the types of ``schema`` and ``rejected_lines`` every
        text that they cannot hold.
        """
        settings = options.pop("settings", None) or Settings()
        if not infer:
            settings = replace(settings, schema=schema)
        return cls(
            spark,
            lambda: ingest_csv(spark, path, None, encoding, infer, multiline),
            prefix,
            settings,
            **options,
        )

    def name(self, table: str) -> str:
        """Catalog name of this build's ``layer.table``."""
        layer, _, short = table.partition(".")
        return f"{self.schemas[layer]}.{short}{self._suffix}"

    def table(self, table: str) -> DataFrame:
        with self._locks[table]:
            if table not in self.counts and not self._opened:
                if table == FIRST_TABLE:
                    create_layers(self.spark, self.schemas.values(), self._location)
                with scratch(self.spark):
                    parts = [OUTCOME] if table == SORTED_TABLE else []
                    by = BUCKETED.get(table)
                    buckets = self._buckets if by else 0
                    self.counts[table] = write_counted(self._builders[table](), self.name(table), parts, buckets, by)
                fit_shuffle(self.spark, self.counts[table])
        return self.spark.table(self.name(table))

    def _clean(self) -> DataFrame:
        """From the sorted lines, if a build has them for both tables of silver; else no other copy of all lines is made."""
        if SORTED_TABLE in self.counts:
            return sorted_clean(self.table(SORTED_TABLE), self.settings)
        return clean_orders(self.bronze(), self.settings, stored=True)[0]

    def _rejected(self) -> DataFrame:
        if SORTED_TABLE in self.counts:
            return sorted_rejected(self.table(SORTED_TABLE))
        return rejected_orders(self.bronze(), self.settings)

    def _known_keys(self, dimension: str) -> DataFrame | None:
        """Natural keys and numbers of all builds up to the one shown; None without any."""
        plain = f"{self.schemas['gold']}.keys_of_{dimension}"
        return self.spark.table(plain) if self.spark.catalog.tableExists(plain) else None

    def _number(self, dimension: str) -> Number:
        known = self._known_keys(dimension) if KEY_STEP in self._steps else None
        return dense_key if known is None else lambda df, on, name: stable_key(df, known, on, name)

    def _keys_after(self, dimension: str) -> DataFrame:
        on, name = NUMBERED[dimension]
        known, now = self._known_keys(dimension), self.gold(dimension)
        return now.select(*on, name) if known is None else extend_keys(known, now, on, name)

    def _pointer(self) -> str:
        """View of one row that names the build shown."""
        return f"{self.schemas['gold']}.current_build"

    def _shown(self) -> list[str]:
        """Tables that stay and have a plain name."""
        return [table for step in self._steps for table in step if table != SORTED_TABLE]

    def bronze(self) -> DataFrame:
        return self.table("bronze.order_lines")

    def silver(self) -> DataFrame:
        return self.table("silver.order_lines")

    def gold(self, table: str) -> DataFrame:
        return self.table(f"gold.{table}")

    def fact(self) -> DataFrame:
        return self.gold("fact_order_line")

    def dimensions(self) -> dict[str, DataFrame]:
        return {name: self.gold(name) for name in DIMENSIONS}

    def rows(self, names: Sequence[str] = DIMENSIONS) -> dict[str, int]:
        """Counted rows of silver and the dimensions ``names``: what decides how they are joined."""
        for table in ("silver.order_lines", *[f"gold.{name}" for name in names]):
            stored = self.table(table)
            if self._opened:
                self.counts.setdefault(table, stored.count())
        dimensions = {name: self.counts[f"gold.{name}"] for name in names}
        return {"silver": self.counts["silver.order_lines"], **dimensions}

    def plan_fact(self, **options) -> DataFrame:
        """The fact as a plan over silver and the dimensions."""
        dims = self.dimensions()
        options = {"null_safe_geo": self.settings.null_safe_geo, **options}
        return build_fact(self.silver(), **dims, rows=self.rows(), **options)

    def build(self) -> dict[str, int]:
        """Build every table; row counts by table.

        The tables of a step are built side by side, so that the small jobs of the dimensions
        do not leave the cluster idle in turn.
        """
        for step in self._steps:
            with ThreadPoolExecutor(len(step)) as pool:
                list(pool.map(self.table, step))
        if not self._opened:
            self._show()
        return {table: self.counts[table] for table in self._shown() if table in self.counts}

    def _show(self) -> None:
        """Let the pointer, then the plain names, show this build, and remove the tables of those before."""
        self.spark.sql(f"CREATE OR REPLACE VIEW {self._pointer()} AS SELECT '{self._suffix}' AS suffix")
        tables = [table.partition(".") for table in self._shown()]
        for layer, _, short in tables:
            schema = self.schemas[layer]
            self.spark.sql(
                f"CREATE OR REPLACE VIEW `{schema}`.`{short}` "
                f"AS SELECT * FROM `{schema}`.`{short}{self._suffix}`"
            )
        for layer, schema in self.schemas.items():
            shorts = {short for of, _, short in tables if of == layer}
            passing = SORTED_TABLE.partition(".")[2]
            for stored in self.spark.catalog.listTables(schema):
                short, mark, _ = stored.name.partition(BUILD_MARK)
                if mark and (short == passing or short in shorts and not stored.name.endswith(self._suffix)):
                    self.spark.sql(f"DROP TABLE IF EXISTS `{schema}`.`{stored.name}`")

    def refresh(self) -> None:
        """Begin another build; the source is read anew on the next use."""
        if self._opened:
            raise ValueError("an opened lakehouse has no source to build from")
        self.counts.clear()
        self._suffix = _new_suffix()

    def drop(self) -> None:
        """Remove all tables with their files."""
        self.counts.clear()
        for schema in self.schemas.values():
            self.spark.sql("DROP SCHEMA IF EXISTS IDENTIFIER(:schema) CASCADE", {"schema": schema})

    def layer_counts(self) -> DataFrame:
        """Rows per table: raw lines, silver and all of gold."""
        tables = {"bronze.order_lines": self.bronze(), "silver.order_lines": self.silver()}
        tables |= {f"gold.{name}": self.gold(name) for name in GOLD_TABLES}
        counted = None
        for table, df in tables.items():
            layer, _, short = table.partition(".")
            one = df.agg(F.count("*").alias("n_rows")).select(
                F.lit(layer).alias("layer"), F.lit(short).alias("table_name"), "n_rows"
            )
            counted = one if counted is None else counted.unionByName(one)
        return counted

    def export(self, folder: str, compression: str = "none") -> None:
        """All gold tables as CSV; the two reports of a few rows as one file each, in their order."""
        tables = {name: self.gold(name) for name in GOLD_TABLES}
        export_csv(tables, folder, single_file=KPIS, largest_first=KPI_ORDER, compression=compression)
