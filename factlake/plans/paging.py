"""Reading on from a bookmark: pages over a sorted key index of one snapshot."""

from __future__ import annotations

from dataclasses import asdict, dataclass
from functools import cached_property

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factlake import schemas as S
from factlake.operators import replay as R
from factlake.plans.replay_plan import Lake, ReplayView, replay_as_of, widen
from factlake.session import materialize

BOOKMARK_DDL = (
    "bookmark_id string, request_identity string, snapshot_identity string, ordering string,"
    "last_provider_ns bigint, last_received_ns bigint, last_capture_id string"
)


@dataclass(frozen=True)
class Bookmark:
    """The place after which a read goes on, bound to the request and the snapshot it was handed out for."""

    request_identity: str | None
    snapshot_identity: str | None
    ordering: str | None
    last_received_ns: int | None
    last_capture_id: str | None
    last_provider_ns: int | None = None


@dataclass(frozen=True)
class Page:
    """Full records with ``position`` and ``has_more``, unordered, and the bookmark after them (None: the end)."""

    records: DataFrame
    next: Bookmark | None


class SnapshotPages:
    """The pages of one view.

    The narrow keys are written once, range-partitioned and sorted by the ordering, with the bounds of every
    file beside them.  A page finds the files that hold its keys from those bounds and reads no other; payloads
    are read from the arrival range of the page.  The index is an ordinary table of the shared folder.
    """

    def __init__(self, view: ReplayView) -> None:
        self.view = view
        self.ordering = view.request.ordering
        self.order = R.ORDER_COLUMNS[self.ordering]

    @cached_property
    def current(self) -> DataFrame:
        """One row: the identities a bookmark must carry."""
        return materialize(self.view.summary().select("request_identity", "snapshot_identity", "ordering"))

    @cached_property
    def index(self) -> DataFrame:
        ranged = self.view.keys.repartitionByRange(*self.order)
        return materialize(ranged.sortWithinPartitions(*self.order))

    @cached_property
    def bounds(self) -> DataFrame:
        """One row per file of the index: its last key and its number of rows."""
        files = self.index.select(F.struct(*self.order).alias("key"), F.col("_metadata.file_path").alias("file"))
        return materialize(files.groupBy("file").agg(F.max("key").alias("last"), F.count(F.lit(1)).alias("n")))

    def check(self, bookmark: Bookmark) -> None:
        """Raise unless the bookmark belongs to this request and snapshot and names one of its members."""
        row = self.index.sparkSession.createDataFrame([{"bookmark_id": "asked", **asdict(bookmark)}], BOOKMARK_DDL)
        first = getattr(bookmark, f"last_{self.order[0]}")
        # a member has the first key of the bookmark, so that only its files are read
        near = self.index.where(F.col(self.order[0]).eqNullSafe(F.lit(first).cast("bigint")))
        outcome = R.resume_check(row, self.current, near).first()["outcome"]
        if outcome != "ok":
            raise S.ContractError(outcome, "the bookmark does not continue this read")

    def keys_from(self, last_key: tuple | None, size: int) -> DataFrame:
        """The index cut to the files that hold the ``size + 1`` keys after ``last_key``."""
        later, start = self.bounds, self.index
        if last_key is not None:
            later = later.where(F.col("last") > F.struct(*[F.lit(v).alias(k) for k, v in zip(self.order, last_key, strict=True)]))
            start = start.where(F.col(self.order[0]) >= F.lit(last_key[0]))
        up_to_here = Window.orderBy("last").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # a row per file
        # the first file may be read in part already, so its rows are not counted
        before = F.sum("n").over(up_to_here) - F.col("n") - F.first("n").over(up_to_here)
        needed = later.withColumn("before", before).where(F.col("before") <= size)
        high = needed.agg(F.max(f"last.{self.order[0]}")).first()[0]
        return start if high is None else start.where(F.col(self.order[0]) <= F.lit(high))

    def read(self, bookmark: Bookmark | None = None, page_size: int | None = None) -> Page:
        """The page after ``bookmark`` (None: the first)."""
        size = page_size or self.view.request.page_size
        if not 0 < size <= self.view.max_page_size:
            raise S.ContractError("INVALID_REQUEST", "page size is outside the bound")
        last_key = None
        if bookmark is not None:
            self.check(bookmark)
            last_key = tuple(getattr(bookmark, f"last_{c}") for c in self.order)
        page = materialize(R.keyset_page(self.keys_from(last_key, size), self.ordering, size, last_key))
        span = page.agg(F.min("received_ns"), F.max("received_ns")).first()
        end = page.where((F.col("position") == size) & F.col("has_more")).first()
        records = widen(self.view.lake, page, self.view.request, received=tuple(span))
        return Page(records, self._after(end) if end else None)

    def _after(self, end) -> Bookmark:
        now = self.current.first()
        return Bookmark(
            now["request_identity"],
            now["snapshot_identity"],
            self.ordering,
            **{f"last_{c}": end[c] for c in self.order},
        )


def read_page(
    lake: Lake,
    request: R.AsOfRequest,
    bookmark: Bookmark | None = None,
    strict: bool = True,
    check_scope: str = "policy",
    max_page_size: int = R.MAX_PAGE_SIZE,
) -> Page:
    """One page of a read that is rebuilt from the lake, as a caller does that kept nothing but a bookmark."""
    view = replay_as_of(lake, request, strict, check_scope, max_page_size)
    return SnapshotPages(view).read(bookmark)
