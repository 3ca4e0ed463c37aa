"""How a job is described: which feeds it reads and which table it makes of them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatlake.functions.rules import MOBILE_PLATFORMS, TV_PLATFORMS, mobile_flag
from beatlake.sources.lake import PLATFORM, Slice

MOBILE_COLUMN = "on_mobile_device"

# Types of published columns where they are not text. What a run contains never chooses them: a value that does
# not fit is NULL.
KINDS = {
    **dict.fromkeys(
        (
            "event_timestamp", "timestamp", "original_timestamp", "received_at", "sent_at", "start_timestamp",
            "end_timestamp",
        ),
        "timestamp",
    ),
    **dict.fromkeys(("on_mobile_device", "has_sso", "has_video", "trial", "stripe_user"), "boolean"),
    **dict.fromkeys(("position", "max_position", "active_seconds", "duration_seconds", "decile", "user_key"), "bigint"),
    **dict.fromkeys(("amount_cents", "count"), "int"),
    "playhead_time": "double",
}


def kind_of(name: str) -> str:
    return KINDS.get(name, "string")


def declared(names: Iterable[str]) -> list[Column]:
    """Columns in their declared types."""
    return [F.col(name).try_cast(kind_of(name)).alias(name) for name in names]


@dataclass(frozen=True)
class Rule:
    """A column made of raw ones: which it reads, and how.

    The expression is made by a function, as Spark expressions need a running session and descriptions do not.
    """

    reads: tuple[str, ...]
    make: Callable[[], Column]

    def __call__(self) -> Column:
        return self.make()


# A plain name stands for the raw column of that name.
Source = str | Rule


@dataclass(frozen=True)
class Feed:
    """One kind of raw event on some platforms, and the columns its files may lack.

    ``nulls`` read as NULL text where missing, ``defaults`` as the given expressions.
    ``mobile`` adds the mobile flag by platform, ``tv_flag`` makes it FALSE for TVs.
    ``user_by_schema`` marks a feed whose user column is picked by what the files have. ``reads`` are the raw
    columns that its job uses, where it declares them.
    """

    segment_type: str | Mapping[str, str]
    platforms: tuple[str, ...]
    nulls: tuple[str, ...] = ()
    defaults: Mapping[str, Callable[[], Column]] = field(default_factory=dict)
    mobile: bool = False
    tv_flag: bool = False
    user_by_schema: bool = False
    reads: tuple[str, ...] = ()

    def segment_type_on(self, platform: str) -> str:
        if isinstance(self.segment_type, str):
            return self.segment_type
        return self.segment_type.get(platform, self.segment_type["*"])

    @property
    def needs_column_presence(self) -> bool:
        """Whether a missing column differs from a NULL, so that days must not be merged."""
        flagged = MOBILE_PLATFORMS + (TV_PLATFORMS if self.tv_flag else ())
        by_flag = self.mobile and any(platform in flagged for platform in self.platforms)
        return by_flag or bool(self.defaults) or self.user_by_schema

    def complete(self, raw: Slice) -> DataFrame:
        """The rows with every optional column present."""
        optional = {name: F.lit(None).cast("string") for name in self.nulls}
        optional.update({name: make() for name, make in self.defaults.items()})
        if self.mobile:
            flag = mobile_flag(F.col(PLATFORM), self.tv_flag)
            optional[MOBILE_COLUMN] = flag.cast("boolean")
        missing = {name: value for name, value in optional.items() if name not in raw.columns}
        return raw.rows.withColumns(missing) if missing else raw.rows


ReadFeed = Callable[[Feed], list[Slice]]


class Job(Protocol):
    """A table a run can build: its published columns, key and order, and how to build it.

    Types are those of ``published_schema``. ``tagged`` adds the input day of each row, which a day table needs.
    """

    name: str
    key: str
    sort_key: str
    needs_users: bool

    @property
    def column_list(self) -> tuple[str, ...]: ...

    def build(self, read: ReadFeed, users: DataFrame | None = None, tagged: bool = False) -> DataFrame | None: ...


def published_schema(job: Job) -> tuple[tuple[str, str], ...]:
    """Names and types of a job's published columns."""
    return tuple((name, kind_of(name)) for name in job.column_list)
