"""Job parameters, taken from the Spark configuration."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

PREFIX = "spark.placeload."


@dataclass(frozen=True)
class LoadConfig:
    """What a load job reads, where it writes and how.

    Without ``jdbc_url`` the destination is a catalog table. ``limit=None`` loads all rows.
    ``num_partitions`` caps the JDBC connections by the number of tasks that write, and so
    the load to as many tasks. ``None`` (0 in the Spark configuration) keeps every task small
    and leaves the cap to the cores the application is given. ``jdbc_options`` go to the driver
    (``jdbc.option.<name>`` in the Spark configuration). ``jdbc_split`` is a whole-number
    expression of the database by which a reload splits the table it reads, see ``read_jdbc``.
    ``jdbc_apply`` says how keyed rows reach the table (``merge``, ``replace`` or ``reload``), and with
    ``jdbc_staged`` a load that replaces a table shows when it is complete. ``ledger`` names a catalog
    table of loaded files: a load then takes only files of ``source`` that are not in it. ``files`` are the
    files of ``source`` to load, all if it is None.
    """

    source: str
    dest_table: str
    limit: int | None = None
    resolution: int | None = None
    jdbc_url: str | None = None
    jdbc_user: str | None = None
    jdbc_password: str | None = field(default=None, repr=False)
    jdbc_driver: str | None = None
    jdbc_options: Mapping[str, str] = field(default_factory=dict)
    num_partitions: int | None = None
    batch_size: int = 1000
    shards: int | None = None
    path: str | None = None
    jdbc_split: str | None = None
    jdbc_apply: str = "merge"
    jdbc_staged: bool = True
    ledger: str | None = None
    files: tuple[str, ...] | None = None

    def __post_init__(self) -> None:
        if self.jdbc_apply not in ("merge", "replace", "reload"):
            raise ValueError(f"jdbc_apply must be merge, replace or reload, got {self.jdbc_apply!r}")
        if self.limit is not None and self.limit < 0:
            raise ValueError(f"limit must not be negative, got {self.limit}")
        if self.ledger is not None and self.limit is not None:
            raise ValueError("a ledger holds files that were loaded as a whole, so it takes no limit")
        for name in ("num_partitions", "batch_size", "shards"):
            value = getattr(self, name)
            if value is not None and value < 1:
                raise ValueError(f"{name} must be at least 1, got {value}")

    @classmethod
    def from_spark(cls, spark: SparkSession, prefix: str = PREFIX) -> LoadConfig:
        """Read ``spark.placeload.*``; an absent or empty key means its default."""

        def text(key: str, required: bool = False) -> str | None:
            value = spark.conf.get(prefix + key, None)
            if required and not value:
                raise ValueError(f"{prefix}{key} is not set")
            return value or None

        def number(key: str, default: int | None) -> int | None:
            value = text(key)
            if value is None:
                return default
            try:
                return int(value)
            except ValueError:
                raise ValueError(f"{prefix}{key} is not a whole number: {value!r}") from None

        return cls(
            source=text("source", required=True),
            dest_table=text("dest_table", required=True),
            limit=number("limit", None),
            resolution=number("resolution", None),
            jdbc_url=text("jdbc.url"),
            jdbc_user=text("jdbc.user"),
            jdbc_password=text("jdbc.password"),
            jdbc_driver=text("jdbc.driver"),
            jdbc_options={
                key.removeprefix(prefix + "jdbc.option."): value
                for key, value in spark.conf.getAll.items()
                if key.startswith(prefix + "jdbc.option.")
            },
            num_partitions=number("num_partitions", None) or None,
            batch_size=number("batch_size", 1000),
            shards=number("shards", None),
            path=text("path"),
            jdbc_split=text("jdbc.split"),
            jdbc_apply=text("jdbc.apply") or "merge",
            ledger=text("ledger"),
            jdbc_staged=(text("jdbc.staged") or "true").lower() == "true",
        )
