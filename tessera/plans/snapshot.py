"""Immutable snapshots of a lake: copy, checksum, manifest, validation.

Files are hashed by Spark (binaryFile), in parallel and in whatever store; only names, sizes and hashes reach the driver."""

import json
import re
import subprocess
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import sinks, tables
from . import report
from .layout import ARTIFACTS, SCHEMA_OF, Lake

_VERSION = re.compile(r"^v?(\d+)\.(\d+)\.(\d+)(?:-([0-9A-Za-z.-]+))?$")
MEDIA = {"parquet": "application/vnd.apache.parquet", "json": "application/json", "csv": "text/csv", "md": "text/markdown"}
REQUIRED = {"lake_version": str, "created_at": str, "producer": dict, "contracts": dict, "files": list, "qa_status": str}


def parse_version(s: str) -> tuple[int, int, int, str]:
    if not (m := _VERSION.match(s)):
        raise ValueError(f"not a version: {s!r}")
    return int(m[1]), int(m[2]), int(m[3]), m[4] or ""


def format_version(v: tuple[int, int, int, str]) -> str:
    return f"v{v[0]}.{v[1]}.{v[2]}" + (f"-{v[3]}" if v[3] else "")


def next_version(spark: SparkSession, root: str, start: str, auto_increment: bool = True) -> str:
    """The first free version from start on, its patch raised as often as needed; without auto_increment a taken one is an error."""
    v = parse_version(start)
    while tables.exists(spark, f"{root}/{format_version(v)}"):
        if not auto_increment:
            raise FileExistsError(f"{root}/{format_version(v)}")
        v = (v[0], v[1], v[2] + 1, v[3])
    return format_version(v)


def writable(spark: SparkSession, root: str) -> bool:
    """Whether a file can be made and removed there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/.probe")
    try:
        sinks.write_text(spark, f"{root}/.probe", "")
        return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, False))
    except Exception:
        return False


def checksums(spark: SparkSession, folder: str) -> DataFrame:
    """path (below folder), bytes, sha256 of each file, hidden ones aside."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select(_below(F.col("path"), folder).alias("path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def rows_by_file(spark: SparkSession, folder: str) -> dict[str, int]:
    """Rows of each Parquet file below folder that has any, in one job."""
    if not any(tables.exists(spark, f"{folder}/{deep}*.parquet") for deep in ("", "*/", "*/*/", "*/*/*/")):
        return {}
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").schema("_none int").parquet(folder)
    return {r.path: r["count"] for r in files.groupBy(_below(F.url_decode(F.regexp_replace("_metadata.file_path", r"\+", "%2B")), folder).alias("path")).count().collect()}


def _below(path, folder: str):
    """The part of a file's path below folder."""
    return F.regexp_replace(F.regexp_replace(path, "^[a-z]+:/*", "/"), f"^{re.escape(re.sub('^[a-z]+:/*', '/', folder)).replace(chr(92) + '/', '/')}/", "")


def _copy(spark: SparkSession, source: str, target: str) -> None:
    fs = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    a, b = fs.Path(source), fs.Path(target)
    fs.FileUtil.copy(a.getFileSystem(conf), a, b.getFileSystem(conf), b, False, conf)


def git_commit() -> str | None:
    try:
        return subprocess.run(["git", "rev-parse", "HEAD"], capture_output=True, text=True, timeout=5, check=True).stdout.strip()
    except (OSError, subprocess.SubprocessError):
        return None


def create(lake: Lake, root: str, version: str = "v0.1.0", lake_version: str = "v1", auto_increment: bool = True, qa_status: str | None = None, reports: str | None = None) -> str:
    """Copies every artifact of a lake version, its catalogs and the newest report below root/<version>, with a manifest and a
    note; returns its path.

    reports: the folder of stamped quality reports. The status is that given, else the newest report's, else UNKNOWN. The
    copy is validated before it is returned."""
    spark = lake.spark
    if not writable(spark, root):
        raise PermissionError(root)
    name = next_version(spark, root, version, auto_increment)
    out, rows = f"{root}/{name}", {}
    for a in ARTIFACTS:
        if lake.exists(a, lake_version):
            _copy(spark, lake.path(a, lake_version), f"{out}/{a}")
            rows[a] = tables.row_count(spark, f"{out}/{a}")
    if not rows:
        raise FileNotFoundError(f"{lake.root} has nothing of {lake_version}")
    if tables.exists(spark, f"{lake.catalogs}/*"):
        _copy(spark, lake.catalogs, f"{out}/catalogs")
    if newest := report.latest(spark, reports) if reports else None:
        _copy(spark, newest, f"{out}/quality_report")
    qa_status = qa_status or (report.status_of(spark, newest) if newest else "UNKNOWN")
    held = rows_by_file(spark, out)
    files = [
        {"path": r.path, "media_type": MEDIA.get(r.path.rsplit(".", 1)[-1], "application/octet-stream"), "bytes": r.bytes, "sha256": r.sha256, "rows": held.get(r.path), "notes": ""}
        for r in checksums(spark, out).orderBy("path").collect()
    ]
    manifest = {
        "lake_version": name, "created_at": time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime()), "producer": {"source": lake.root, "source_version": lake_version, "commit": git_commit()},
        "contracts": {a: {"schema": SCHEMA_OF.get(a), "rows": n} for a, n in rows.items()}, "files": files, "qa_status": qa_status,
    }
    sinks.write_text(spark, f"{out}/lake_manifest.json", json.dumps(manifest, indent=2))
    sinks.write_text(spark, f"{out}/README.md", f"Snapshot {name}\n\nRead-only copy of {lake.root} ({lake_version}). Check it against lake_manifest.json before use.\n")
    found = validate(spark, out)
    if not found["valid"]:
        raise RuntimeError(f"the snapshot is damaged: {found['errors']}")
    return out


def validate(spark: SparkSession, path: str) -> dict:
    """valid, errors and warnings: the folder, the manifest's keys, then each file's presence, size and hash, then the QA status."""
    errors, warnings = [], []
    if not tables.exists(spark, path):
        return {"valid": False, "errors": [f"{path} does not exist"], "warnings": []}
    if not tables.exists(spark, f"{path}/lake_manifest.json"):
        return {"valid": False, "errors": ["no manifest"], "warnings": []}
    try:
        manifest = json.loads(sinks.read_text(spark, f"{path}/lake_manifest.json"))
    except ValueError as e:
        return {"valid": False, "errors": [f"the manifest is not JSON: {e}"], "warnings": []}
    errors += [f"manifest: {k} is missing or not a {t.__name__}" for k, t in REQUIRED.items() if not isinstance(manifest.get(k), t)]
    listed = [(f["path"], f["bytes"], f["sha256"]) for f in manifest.get("files") or []]
    if listed:
        want = spark.createDataFrame(listed, "path string, want_bytes long, want_sha string")
        for r in want.join(checksums(spark, path), "path", "left").where("bytes is null or bytes <> want_bytes or sha256 <> want_sha").orderBy("path").collect():
            errors.append(f"{r.path}: " + ("missing" if r.bytes is None else f"{r.bytes} bytes, not {r.want_bytes}" if r.bytes != r.want_bytes else "the checksum differs"))
    status = manifest.get("qa_status")
    if status not in ("GREEN", "PASS"):
        warnings.append(f"quality status {status}")
    return {"valid": not errors, "errors": errors, "warnings": warnings}


def validation_report(found: dict) -> str:
    return "\n".join([f"{'valid' if found['valid'] else 'INVALID'}", *[f"error: {e}" for e in found["errors"]], *[f"warning: {w}" for w in found["warnings"]]])


def archive(lake: Lake, version: str, target: str, dry_run: bool = False) -> list[str]:
    """Copies a version's folders to target and lists them in a manifest; dry_run only lists."""
    found = [a for a in ARTIFACTS if lake.exists(a, version)]
    if not dry_run:
        for a in found:
            _copy(lake.spark, lake.path(a, version), f"{target}/{a}")
        sinks.write_text(lake.spark, f"{target}/archive.json", json.dumps({"source": lake.root, "version": version, "folders": found}))
    return found
