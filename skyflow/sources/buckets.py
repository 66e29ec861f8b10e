"""The stored state: tables partitioned by zones of the sky, of which a batch rewrites only those it touches."""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import schemas
from ..functions.sky import MATCH_RADIUS_DEG, with_ball_cells, with_cell
from .state import SkyState, empty_state

ZONE_DEG = 5.0            # a zone is about this high and wide: 1,700 of them
ROWS_PER_FILE = 1_000_000
KEPT_STAGES = 2           # staged batches that stay for those who still read them


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    folder, fs = _file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []


_BY_ZONE = {"objects": schemas.OBJECTS, "native_names": schemas.NATIVE_NAMES, "selections": schemas.SELECTIONS}


class BucketStore:
    """
    The state under one root:

        <root>/objects/zone=<z>/         parquet; native_names and selections alike, in the zone of their object
        <root>/nights/survey_id=<s>/     parquet
        <root>/pointer/<n>.json          what batches have been applied, and where ids and names go on; the highest number counts

    An object never changes its position, so a batch at one place of the sky rewrites the zones there and leaves all other files alone. `merge` stages
    the new contents of the touched zones, writes a pointer that names the stage, lets Spark overwrite just those partitions (dynamic
    partition overwrite), and writes a pointer that names no stage. After a crash in between, the next access overwrites the same
    partitions with the same staged rows again: all tables of a batch and its pointer change together or not at all. One
    writer at a time: the second one of two fails, as it cannot create its pointer file. Readers who want one state read it while nothing is merged.
    """

    def __init__(self, spark: SparkSession, root: str, zone_deg: float = ZONE_DEG):
        self.spark, self.root, self.zone_deg = spark, root.rstrip("/"), zone_deg

    # ------------------------------------------------------------ pointer

    def _numbers(self) -> list[int]:
        return sorted(int(n.split(".")[0]) for n in _names(self.spark, f"{self.root}/pointer") if n.endswith(".json"))

    def _read_pointer(self) -> dict:
        numbers = self._numbers()
        for number in reversed(numbers):
            try:
                text = self.spark.read.text(f"{self.root}/pointer/{number}.json", wholetext=True).first()
                return {**json.loads(text[0]), "number": numbers[-1]}
            except (TypeError, ValueError):      # its writer died over it
                continue
        return {"number": 0, "zone_deg": self.zone_deg, "applied": {}, "stage": None}

    def _write_pointer(self, pointer: dict) -> dict:
        pointer = {**pointer, "number": pointer["number"] + 1}
        target, fs = _file_system(self.spark, f"{self.root}/pointer/{pointer['number']}.json")
        out = fs.create(target, False)          # fails if another writer was faster
        try:
            out.write(bytearray(json.dumps(pointer), "utf-8"))
        finally:
            out.close()
        return pointer

    def pointer(self) -> dict:
        """What is stored: number, zone_deg, applied (by stream) and whatever else batches recorded. A merge that was cut short is finished first."""
        pointer = self._read_pointer()
        if pointer["zone_deg"] != self.zone_deg:
            raise ValueError(f"the state has zones of {pointer['zone_deg']} degrees")
        return self._apply(pointer) if pointer["stage"] else pointer

    # ------------------------------------------------------------ reading

    def zoned(self, df: DataFrame) -> DataFrame:
        """`df` (ra, dec) plus `zone`."""
        return with_cell(df, "ra", "dec", self.zone_deg, "zone")

    def zones_near(self, points: DataFrame, radius_deg: float = MATCH_RADIUS_DEG) -> list[int]:
        """The zones in which an object within the radius of a point can lie. At most all zones of the sky, which the zone's size bounds."""
        cells = with_ball_cells(points.select("ra", "dec"), "ra", "dec", radius_deg, self.zone_deg, "zone")
        return [r["zone"] for r in cells.select("zone").distinct().collect()]

    def _table(self, name: str, zones: list[int] | None) -> DataFrame | None:
        """A table with its zone column; of the given zones only their folders are listed and read."""
        schema = T.StructType([*_BY_ZONE[name].fields, T.StructField("zone", T.LongType())])
        base = f"{self.root}/{name}"
        stored = {n for n in _names(self.spark, base) if n.startswith("zone=")}
        wanted = stored if zones is None else stored & {f"zone={z}" for z in zones}
        if not wanted:
            return None
        paths = [base] if wanted == stored else [f"{base}/{n}" for n in sorted(wanted)]
        return self.spark.read.schema(schema).option("basePath", base).parquet(*paths)

    def load(self, zones: list[int] | None = None) -> SkyState:
        """The state, or what lies in some zones of it (nights are always whole)."""
        self.pointer()
        state = empty_state(self.spark)
        for name, schema in _BY_ZONE.items():
            rows = self._table(name, zones)
            if rows is not None:
                state = state.with_tables(**{name: rows.select(*schema.names)})
        if _names(self.spark, f"{self.root}/nights"):
            nights = self.spark.read.schema(schemas.NIGHTS).parquet(f"{self.root}/nights")
            state = state.with_tables(nights=nights.select(*schemas.NIGHTS.names))
        return state

    def near(self, points: DataFrame, radius_deg: float = MATCH_RADIUS_DEG) -> SkyState:
        """What is stored around the points: all that a batch of them can match or change."""
        return self.load(self.zones_near(points, radius_deg))

    # ------------------------------------------------------------ writing

    def merge(self, state: SkyState, touched: DataFrame, **recorded) -> list[int]:
        """
        Make `state` current in the zones of `touched` (object_id, ra, dec: the objects that a batch made or changed) and return these. `state`
        must hold all that is stored in those zones, as `near` gives it. `recorded` is kept in the pointer (JSON).
        """
        pointer = self.pointer()
        zones = [r["zone"] for r in self.zoned(touched.select("ra", "dec")).select("zone").distinct().collect()]      # bounded as in zones_near
        stage = f"{self.root}/stage/{pointer['number'] + 1}"
        objects = self.zoned(state.objects).filter(F.col("zone").isin(zones))
        objects.write.mode("overwrite").parquet(f"{stage}/objects")
        place = self.spark.read.schema("object_id bigint, zone bigint").parquet(f"{stage}/objects")
        for name in ("native_names", "selections"):
            getattr(state, name).join(place, "object_id").write.mode("overwrite").parquet(f"{stage}/{name}")
        state.nights.write.mode("overwrite").parquet(f"{stage}/nights")
        self._apply(self._write_pointer({**pointer, **recorded, "stage": stage}))
        return sorted(zones)

    def record(self, **recorded) -> None:
        """Keep something in the pointer without changing a table."""
        self._write_pointer({**self.pointer(), **recorded})

    def _overwrite(self, stage: str, name: str) -> None:
        """Put the staged rows of a table in place of the partitions that they are of."""
        key = "zone" if name in _BY_ZONE else "survey_id"
        fields = [*_BY_ZONE[name].fields, T.StructField("zone", T.LongType())] if name in _BY_ZONE else schemas.NIGHTS.fields
        rows = self.spark.read.schema(T.StructType(fields)).parquet(f"{stage}/{name}")
        # a zone is one file, or several where it holds much
        few = rows.count() <= ROWS_PER_FILE
        dealt = rows.repartition(self.spark.sparkContext.defaultParallelism, key) if few else rows.hint("rebalance", key)
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(f"{self.root}/{name}")

    def _apply(self, pointer: dict) -> dict:
        with ThreadPoolExecutor(4) as pool:
            for written in [pool.submit(self._overwrite, pointer["stage"], name) for name in (*_BY_ZONE, "nights")]:
                written.result()
        done = self._write_pointer({**pointer, "stage": None})
        self._forget(done["number"])
        return done

    def _forget(self, number: int) -> None:
        """Stages and pointers of long ago."""
        for folder, kept in (("stage", KEPT_STAGES), ("pointer", 10 * KEPT_STAGES)):
            for name in _names(self.spark, f"{self.root}/{folder}"):
                if int(name.split(".")[0]) <= number - kept * 2:
                    target, fs = _file_system(self.spark, f"{self.root}/{folder}/{name}")
                    fs.delete(target, True)
