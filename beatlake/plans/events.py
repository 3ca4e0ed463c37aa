"""Event jobs: complete, rename and clean the rows of a feed, one row per message."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatlake.functions.rules import date_parts, is_not_bot
from beatlake.operators.combine import union_present
from beatlake.operators.dedup import keep_least
from beatlake.plans.model import Feed, ReadFeed, Source, kind_of
from beatlake.sources.lake import PLATFORM, RUN_DATE, Slice, with_run_date

AGENT_COLUMN = "context_user_agent"
_PART = "_part"


@dataclass(frozen=True)
class Part:
    """A feed and the output columns it fills, in order."""

    feed: Feed
    columns: tuple[tuple[str, Source], ...]

    def reading(self, skip_bots: bool) -> Feed:
        """The feed with the raw columns that this part reads."""
        names = [name for _, source in self.columns for name in ([source] if isinstance(source, str) else source.reads)]
        return replace(self.feed, reads=(*names, *([AGENT_COLUMN] if skip_bots else [])))

    def project(self, raw: Slice, skip_bots: bool, number: int) -> DataFrame:
        rows = self.feed.complete(raw)
        if skip_bots:
            rows = rows.where(is_not_bot(F.col(AGENT_COLUMN)))
        return rows.select(
            *(_expression(source).try_cast(kind_of(name)).alias(name) for name, source in self.columns),
            PLATFORM,
            RUN_DATE,
            F.lit(number).alias(_PART),
        )


def _expression(source: Source) -> Column:
    return F.col(source) if isinstance(source, str) else source()


@dataclass(frozen=True)
class EventJob:
    """A table with one row per message of its feeds.

    Messages are deduplicated within their input day, platform and feed: the same id in two of
    them is two rows. All of them are unioned first, so there is one shuffle however many there are.
    ``sort_key`` is the output column with the event's time, which also dates the row.
    """

    name: str
    key: str
    parts: tuple[Part, ...]
    sort_key: str = "event_timestamp"
    skip_bots: bool = False
    drop_null_first: tuple[str, ...] = ()
    drop_null_last: tuple[str, ...] = ()
    dedup: bool = True
    needs_users: bool = False

    @property
    def column_list(self) -> tuple[str, ...]:
        return tuple(name for name, _ in self.parts[0].columns)

    def build(self, read: ReadFeed, users: DataFrame | None = None, tagged: bool = False) -> DataFrame | None:
        rows = union_present(
            part.project(raw, self.skip_bots, number)
            for number, part in enumerate(self.parts)
            for raw in read(part.reading(self.skip_bots))
        )
        if rows is None:
            return None
        if self.drop_null_first:
            rows = rows.na.drop(subset=list(self.drop_null_first))
        if self.dedup:
            rows = keep_least(rows, [self.key, PLATFORM, RUN_DATE, _PART], [self.sort_key])
        if self.drop_null_last:
            rows = rows.na.drop(subset=list(self.drop_null_last))
        return rows.select(*self.column_list, *date_parts(F.col(self.sort_key)), *with_run_date(tagged))
