"""A stored table with a key, kept current by upserts, on plain Parquet.

Rows lie in a bucketed table: Spark knows that equal keys are in one bucket, so nothing that is stored
is shuffled again. An upsert adds its changes beside it, in as few files as they fill, and rewrites
nothing; reading joins the newest change of each key to the table, for which only the changes are
shuffled. When they have grown to a share of the table, it is compacted into a new generation.

What belongs to the table is told by a small published state and by nothing else: which generation,
and which writes in it. Rows of a write that is not named there, say of a writer that died, are not
part of the table. Readers keep the state they began with. One writer at a time.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayblotter.functions.columns import conform, missing_to_null, quoted, sql_literal
from dayblotter.operators.upsert import latest_per_key, stack_changes
from dayblotter.schemas import TableSpec
from dayblotter.session import publish, published, remove_folder, stored_bytes

_WRITE = "_write"
_DAY = "_day"  # of the time that rows are laid out by; footers of wall-clock times are not looked at, those of dates are
BUCKET_BYTES = 256 << 20
COMPACT_SHARE = 0.3
MOST_WRITES = 100


def buckets_for(stored: int, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets for a table that will hold this many bytes, `bucket_bytes` in each, 8 at least."""
    return max(8, -(-stored // bucket_bytes))


class KeyedTable:
    """`compact_share` and `most_writes` say when changes are folded in: when they are that share of
    the table's bytes, or that many writes."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        spec: TableSpec,
        compact_share: float = COMPACT_SHARE,
        most_writes: int = MOST_WRITES,
    ) -> None:
        self.spark, self.path, self.spec = spark, path.rstrip("/"), spec
        self.states = f"{self.path}/states"
        self.compact_share, self.most_writes = compact_share, most_writes
        day = [T.StructField(_DAY, T.DateType())] if spec.laid_out_by else []
        self.stored = T.StructType([*spec.schema.fields, *day, T.StructField(_WRITE, T.StringType())])

    def exists(self) -> bool:
        return published(self.spark, self.states) is not None

    def create(self, expected_bytes: int | None = None) -> KeyedTable:
        """Declare the table if it is not there.

        Its buckets are as declared, or follow from the bytes it will hold; one of the two is needed.
        `rebucket` changes them later.
        """
        if not self.exists():
            if self.spec.buckets is None and expected_bytes is None:
                raise ValueError(f"{self.spec.name} needs a number of buckets or the bytes to be expected")
            buckets = self.spec.buckets or buckets_for(expected_bytes)
            state = {"generation": self._new_name(), "buckets": buckets, "writes": {}, "changes": {}, "older": []}
            publish(self.spark, self.states, state)
        return self

    @property
    def buckets(self) -> int:
        return self._state()["buckets"]

    def read(self) -> DataFrame:
        return self.spark.sql(self.read_sql())

    def read_sql(self) -> str:
        """The table as it is now, as a query that a view in the catalog can hold."""
        return self._newest_sql(self._state())

    def read_window(self, start, end) -> DataFrame:
        """The rows whose `laid_out_by` is from `start` to `end`, both inside, as `read` has them.

        Row groups are left out by their footers. Of the first write, which holds most rows, those are
        read that have rows in the window; of later writes all, as what they change may leave the window
        or come into it. A row in the window of a later write may be older than what the first write has
        of its key, outside the window; so rows of the first write that are as new are read as well.
        Changes that come by change time have none of these.
        """
        if not (self.spec.laid_out_by and self.spec.newest):
            raise ValueError(f"{self.spec.name} has to say what it is laid out by and which of two rows is newer")
        state = self._state()
        writes = list(state["writes"])
        inside = F.col(quoted(self.spec.laid_out_by)).between(start, end)
        near = F.col(_DAY).between(F.to_date(start), F.to_date(end))
        stored, newest = self.spark.table(self._relation(state)), F.col(quoted(self.spec.newest[0]))
        if len(writes) < 2 and not state.get("changes"):
            one = stored.where(F.col(_WRITE).isin(writes)).where(near & inside)
            return one.select(*map(quoted, self.spec.schema.names))
        columns = [*map(quoted, self.spec.schema.names), _WRITE]
        changes = stored.where(F.col(_WRITE).isin(writes[1:])).select(*columns)
        if state.get("changes"):
            changes = changes.unionByName(self.spark.sql(f"select {', '.join(columns)} from {self._changes_sql(state)}"))
        least, unknown = changes.where(inside).agg(F.min(newest), F.count_if(newest.isNull())).first()
        needed = near
        if unknown:
            needed = F.lit(True)
        elif least is not None:
            needed = needed | (newest >= F.lit(least))
        rows = stored.where(F.col(_WRITE).isin(writes[:1])).where(needed).select(*columns).unionByName(changes)
        ranked = [name for name in (*self.spec.newest, _WRITE) if name not in self.spec.keys]
        found = latest_per_key(rows, self.spec.keys, ranked)
        return found.select(*map(quoted, self.spec.schema.names)).where(inside)

    def _changes_sql(self, state: dict) -> str:
        """The changes beside a generation, as something to select from."""
        live = ", ".join(map(sql_literal, state["changes"]))
        return f"(select * from parquet.`{self._changes_folder(state)}` where {_WRITE} in ({live}))"

    def _changes_folder(self, state: dict, generation: str | None = None) -> str:
        return f"{self.path}/changes-{(generation or state['generation']).removeprefix('data-')}"

    def _newest_sql(self, state: dict) -> str:
        """The bucketed rows under the newest change of their key, which wins unless it is older.

        A join on what rows are bucketed by needs no shuffle of them.
        """
        if not state.get("changes"):
            return self._bucketed_sql(state)
        keys, newest = self.spec.keys, self.spec.newest
        others = [name for name in self.spec.schema.names if name not in keys]
        named = ", ".join(quoted(key) for key in keys)
        ranked = [*newest, _WRITE, *[name for name in others if name not in newest]]
        best = f"max(struct({', '.join(map(quoted, ranked))})) as _best"
        # Dealt as the buckets are, or Spark might deal the table as it deals the changes.
        dealt = f"(select /*+ repartition({state['buckets']}, {named}) */ * from {self._changes_sql(state)})"
        changes = f"select {named}, {best} from {dealt} group by {named}"
        same = " and ".join(f"{quoted('b', key)} = {quoted('c', key)}" for key in keys)
        later = "true"
        if newest:
            of_both = [", ".join(quoted(*side, name) for name in newest) for side in (("c", "_best"), ("b",))]
            later = f"struct({of_both[0]}) >= struct({of_both[1]})"
        first = keys[0]
        wins = f"{quoted('c', first)} is not null and ({quoted('b', first)} is null or {later})"
        picked = [
            f"coalesce({quoted('b', name)}, {quoted('c', name)}) as {quoted(name)}" if name in keys
            else f"if({wins}, {quoted('c', '_best', name)}, {quoted('b', name)}) as {quoted(name)}"
            for name in self.spec.schema.names
        ]
        return f"select {', '.join(picked)} from ({self._bucketed_sql(state)}) b full outer join ({changes}) c on {same}"

    def _bucketed_sql(self, state: dict) -> str:
        """Grouping by the key needs no shuffle, for the key is what rows are bucketed by."""
        relation, writes = self._relation(state), list(state["writes"])
        names = [quoted(name) for name in self.spec.schema.names]
        live = f"{_WRITE} in ({', '.join(map(sql_literal, writes))})" if writes else "false"
        others = [name for name in self.spec.schema.names if name not in self.spec.keys]
        if len(writes) < 2:
            return f"select {', '.join(names)} from {relation} where {live}"
        keys = ", ".join(quoted(key) for key in self.spec.keys)
        ranked = [*self.spec.newest, _WRITE, *[name for name in others if name not in self.spec.newest]]
        best = f"max(struct({', '.join(map(quoted, ranked))})) as _best"
        picked = [
            quoted(name) if name in self.spec.keys else f"{quoted('_best', name)} as {quoted(name)}"
            for name in self.spec.schema.names
        ]
        return (
            f"select {', '.join(picked)} from "
            f"(select {keys}, {best} from {relation} where {live} group by {keys})"
        )

    def upsert(self, changes: DataFrame, stale: str = "keep") -> None:
        """Merge changes in by key; no changes, no work.

        The first rows are shuffled into buckets. Later ones are shuffled once for the newest of each
        key, and make as many files as Spark has partitions of a good size for them, one if they are
        few, however many buckets they fall into; what is stored is neither read nor written. With stale="replace" a change wins over what is newer than it, which no order of
        rows can express: the table is then written anew. A NULL in a key is an error, and nothing
        of those changes is stored.
        """
        if stale not in ("keep", "replace"):
            raise ValueError("stale is 'keep' or 'replace'")
        state = self._state()
        arriving = missing_to_null(conform(changes, self.spec.schema))
        refused = F.raise_error(F.lit(f"{self.spec.name}: NULL in a key"))
        checked = arriving.withColumns(
            {key: F.when(F.col(quoted(key)).isNull(), refused).otherwise(F.col(quoted(key))) for key in self.spec.keys}
        )
        arriving = checked if state["writes"] and stale == "keep" else self._by_bucket(checked, state["buckets"])
        newest = latest_per_key(arriving, self.spec.keys, self.spec.newest)
        if stale == "replace" and state["writes"]:
            if not newest.isEmpty():
                both, order = stack_changes(self.read(), newest, self.spec.newest, stale)
                merged = latest_per_key(self._by_bucket(both, state["buckets"]), self.spec.keys, order)
                self._new_generation(state, merged.drop("_incoming"), state["buckets"])
            return
        into, write = ("changes", self._beside(newest, state)) if state["writes"] else ("writes", self._written(newest, state))
        if write is None:
            return
        state = publish(self.spark, self.states, {**state, into: {**state.get(into, {}), **write}})
        sizes, changes = list(state["writes"].values()), list(state.get("changes", {}).values())
        if sum(sizes[1:]) + sum(changes) > self.compact_share * sizes[0] or len(sizes) + len(changes) > self.most_writes:
            self.compact()

    def compact(self) -> None:
        """Fold all writes into one, bucket by bucket, without a shuffle of what is stored."""
        state = self._state()
        if len(state["writes"]) > 1 or state.get("changes"):
            self._new_generation(state, self.read(), state["buckets"])

    def rebucket(self, buckets: int) -> None:
        """Write the table anew with another number of buckets; one shuffle of all rows."""
        state = self._state()
        self._new_generation(state, self._by_bucket(self.read(), buckets), buckets)

    def _state(self) -> dict:
        state = published(self.spark, self.states)
        if state is None:
            raise ValueError(f"there is no table at {self.path}")
        return state

    @staticmethod
    def _new_name() -> str:
        return f"data-{uuid.uuid4().hex}"

    def _by_bucket(self, rows: DataFrame, buckets: int) -> DataFrame:
        """A task for each bucket: this is the hash that Spark buckets by."""
        return rows.repartition(buckets, *[quoted(key) for key in self.spec.keys])

    def _relation(self, state: dict) -> str:
        """The catalog's name for a generation, which is declared there if it is not yet."""
        folder = f"{self.path}/{state['generation']}"
        name = f"keyed_{hashlib.md5(folder.encode()).hexdigest()}"
        columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in self.stored.fields)
        keys = ", ".join(quoted(key) for key in self.spec.keys)
        order = f"sorted by ({quoted(self.spec.laid_out_by)}) " if self.spec.laid_out_by else ""
        self.spark.sql(
            f"create table if not exists {name} ({columns}) using parquet "
            f"options ('parquet.block.size' = '{self.spec.row_group_bytes}') "
            f"clustered by ({keys}) {order}into {state['buckets']} buckets "
            f"location {sql_literal(folder)}"
        )
        self.spark.catalog.refreshTable(name)  # another session may have written
        return name

    def _written(self, rows: DataFrame, state: dict) -> dict[str, int] | None:
        """Add rows to a generation, under a name that no state has yet; its size, None without rows."""
        relation, folder = self._relation(state), f"{self.path}/{state['generation']}"
        # Names sort in the order of writing.
        write = f"{state.get('version', 0):012d}-{uuid.uuid4().hex}"
        before = stored_bytes(self.spark, folder)
        if self.spec.laid_out_by:
            rows = rows.withColumn(_DAY, F.to_date(quoted(self.spec.laid_out_by)))
        rows.withColumn(_WRITE, F.lit(write)).write.insertInto(relation)
        if self.spark.table(relation).where(F.col(_WRITE) == write).isEmpty():
            return None
        return {write: stored_bytes(self.spark, folder) - before}

    def _beside(self, rows: DataFrame, state: dict) -> dict[str, int] | None:
        """Add rows beside a generation, under a name that no state has yet; its size, None without rows."""
        write = f"{state.get('version', 0):012d}-{uuid.uuid4().hex}"
        folder = f"{self._changes_folder(state)}/{_WRITE}={write}"
        rows.write.parquet(folder)
        if self.spark.read.schema(self.spec.schema).parquet(folder).isEmpty():
            remove_folder(self.spark, folder)
            return None
        return {write: stored_bytes(self.spark, folder)}

    def _new_generation(self, state: dict, rows: DataFrame, buckets: int) -> None:
        """All rows in a new folder, published when it is whole. The generation before stays for those
        who read it, until there is a newer one."""
        new = {**state, "generation": self._new_name(), "buckets": buckets, "changes": {}}
        write = self._written(rows, new) or {}
        publish(
            self.spark, self.states, {**new, "writes": write, "older": [state["generation"]]}
        )
        for generation in state["older"]:
            folder = f"{self.path}/{generation}"
            self.spark.sql(f"drop table if exists keyed_{hashlib.md5(folder.encode()).hexdigest()}")
            remove_folder(self.spark, folder)
            remove_folder(self.spark, self._changes_folder(state, generation))
