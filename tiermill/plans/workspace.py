"""A built lake over the test tables, shared by the registered queries.

The raw file is derived from the TPC-H style tables by Spark, written as
delimited text under the shared scratch folder, and run through every
layer once per (application, input folder); queries then read the stored
layers, as a user of the library would.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tiermill.plans.medallion import run
from tiermill.session import cut_lineage, new_scratch_path, session_id
from tiermill.sources.fixture import expected_reference, joined_lines, raw_rows, write_raw_csv


@dataclass(frozen=True)
class Workspace:
    sf_dir: str
    base: str
    dirty: bool = False

    @property
    def raw_path(self) -> str:
        return f"{self.base}/raw/beneficiarios"

    @property
    def reference_path(self) -> str:
        return f"{self.base}/reference"

    @property
    def root(self) -> str:
        return f"{self.base}/lake"

    @property
    def out_dir(self) -> str:
        return f"{self.base}/output"


_BUILT: dict[tuple[str, str, bool], Workspace] = {}


_LINES: dict[tuple[str, str], DataFrame] = {}


def stored_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined lines of ``sf_dir``, written once in this application: the clean and the dirty delivery are made of them."""
    key = (session_id(spark), sf_dir.rstrip("/"))
    if key not in _LINES:
        _LINES[key] = cut_lineage(joined_lines(spark, key[1]))
    return _LINES[key]


def build_workspace(spark: SparkSession, sf_dir: str, dirty: bool = False) -> Workspace:
    """Derive the raw file and run all layers into a fresh scratch folder."""
    ws = Workspace(sf_dir.rstrip("/"), new_scratch_path(spark, "lake"), dirty)
    write_raw_csv(raw_rows(spark, ws.sf_dir, stored_lines(spark, ws.sf_dir), dirty), ws.raw_path)
    run(spark, ws.raw_path, ws.root, ws.out_dir)
    return ws


def workspace(spark: SparkSession, sf_dir: str, dirty: bool = False) -> Workspace:
    """The lake for ``sf_dir`` in this application, built on first use."""
    key = (session_id(spark), sf_dir.rstrip("/"), dirty)
    if key not in _BUILT:
        _BUILT[key] = build_workspace(spark, sf_dir, dirty)
    return _BUILT[key]


def reference_row(spark: SparkSession, ws: Workspace) -> DataFrame:
    """The expected reference values, computed from the test tables on first use and stored as one row."""

    def build() -> DataFrame:
        expected_reference(spark, ws.sf_dir).write.mode("overwrite").parquet(ws.reference_path)
        return spark.read.parquet(ws.reference_path)

    return workspace_frame(spark, ws, "reference", build)


def adopt_workspace(spark: SparkSession, ws: Workspace) -> None:
    """Register an already built lake so the registered queries reuse it."""
    _BUILT[(session_id(spark), ws.sf_dir, ws.dirty)] = ws


_FRAMES: dict[tuple[str, str, str], object] = {}


def workspace_frame(spark: SparkSession, ws: Workspace, name: str, build):
    """A loaded frame of the (immutable) built lake, kept per workspace.

    A scan DataFrame holds its file listing, so reusing it across queries
    avoids listing the month folders and reading Parquet footers again;
    the lake is never rewritten after it is built.
    """
    key = (session_id(spark), ws.base, name)
    if key not in _FRAMES:
        _FRAMES[key] = build()
    return _FRAMES[key]
