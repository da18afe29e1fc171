"""Export package: chunks, vectors, entities, manifest, skip manifest, report, history, pointer; plus verified copies."""

from __future__ import annotations

import json
import os
import shutil
from collections.abc import Iterator
from datetime import datetime, timezone
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import paths as P
from ..plans.shared import discard, materialize, ship_package


def write_jsonl(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """One JSON object a line, non-ASCII kept, one file a partition in the order of the keys."""
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    rows.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)


def write_npy(vectors: DataFrame, path: str, key: str, dim: int, dtype: str = "float16") -> int:
    """Vectors in key order as one ``.npy`` file with the keys beside it, on a file system that driver and executors share.

    The driver writes the header and makes the file its full size; every partition writes its rows in place, so no vector passes the driver.
    """
    ship_package(vectors.sparkSession)
    kind = np.dtype(dtype)
    rows = materialize(vectors.repartitionByRange(key).sortWithinPartitions(key).select(key, "vector", F.spark_partition_id().alias("_p")))
    counts = {r["_p"]: r["n"] for r in rows.groupBy("_p").agg(F.count(F.lit(1)).alias("n")).collect()}
    first, n = {}, 0
    for p in sorted(counts):
        first[p], n = n, n + counts[p]
    path = path.removeprefix("file://")
    np.lib.format.open_memmap(path, "w+", kind, (n, dim)).flush()
    with open(path, "rb") as f:
        np.lib.format.read_magic(f)
        np.lib.format.read_array_header_1_0(f)
        start = f.tell()

    def put(t: pa.Table) -> pa.Table:
        t = t.sort_by(key)
        p = t["_p"][0].as_py()
        v = np.array(t["vector"].to_pylist(), np.float32).astype(kind).reshape(len(t), dim)
        with open(path, "r+b") as f:
            f.seek(start + first[p] * dim * kind.itemsize)
            f.write(v.tobytes())
        return pa.table({"_p": pa.array([p], pa.int32()), "n": pa.array([len(t)], pa.int64())})

    if n:
        rows.groupBy("_p").applyInArrow(put, "_p int, n bigint").count()
    write_jsonl(rows.select(key), path + ".keys.jsonl", [key])
    discard(rows)
    return n


def manifest(chunks: DataFrame, entities: DataFrame, dim: int, dtype: str, model: str, stats: dict | None = None) -> dict:
    return {"version": 1, "timestamp": datetime.now(timezone.utc).isoformat(timespec="seconds"), "chunk_count": chunks.count(), "vector_dim": dim, "vector_dtype": dtype, "embedding_model": model, "entity_count": entities.count(), "stats": stats or {}}


def skip_manifest(skipped: DataFrame, deferred: dict[str, str] | None = None, most_files: int = 10_000) -> dict:
    """Totals by reason, the deferred formats with their counts and names, and the files, also under the older names.

    The list of files goes whole beside the manifest as JSON lines; within it stand at most ``most_files``, in path order, and how many there are.
    """
    by = {r["reason"]: r["n"] for r in skipped.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).collect()}
    late = skipped.where("status = 'deferred'") if "status" in skipped.columns else skipped.limit(0)
    formats = late.groupBy(P.ext(F.col("path")).alias("ext")).agg(F.count(F.lit(1)).alias("n")).orderBy("ext").collect()
    files = [{"path": r["path"], "reason": r["reason"]} for r in skipped.select("path", "reason").orderBy("path", "reason").limit(most_files).collect()]
    total = sum(by.values())
    return {
        "total_skipped": total, "count": total, "counts_by_reason": dict(sorted(by.items(), key=lambda x: (-x[1], x[0]))), "files": files, "skipped_files": files, "files_listed": len(files),
        "deferred_formats": [{"extension": r["ext"].lstrip("."), "count": r["n"], "reason": (deferred or {}).get(r["ext"], "")} for r in formats],
    }


def run_report(m: dict, skips: dict, stats: dict) -> str:
    """Report for readers: what was exported, run statistics, skips by reason, deferred formats."""
    part = lambda title, rows: [title, *(f"  {k}: {v}" for k, v in rows), ""] if rows else []
    lines = part("Export", [(k, v) for k, v in m.items() if not isinstance(v, dict)])
    lines += part("Run", sorted((k, v) for k, v in stats.items() if not isinstance(v, dict)))
    lines += part("Formats", sorted((stats.get("formats") or {}).items()))
    lines += part("Skipped", list(skips["counts_by_reason"].items()))
    lines += part("Deferred formats", [(r["extension"], f"{r['count']} ({r['reason']})" if r["reason"] else r["count"]) for r in skips["deferred_formats"]])
    return "\n".join(lines)


def point_latest(root: Path, folder: Path) -> None:
    link = root / "latest"
    try:
        if link.is_symlink() or link.is_file():
            link.unlink()
        link.symlink_to(folder.name, target_is_directory=True)
    except OSError:
        link.write_text(folder.name, "utf-8")


def append_history(path: Path, row: dict, keep: int = 10) -> None:
    rows = [x for x in path.read_text("utf-8").splitlines() if x.strip()] if path.exists() else []
    path.write_text("\n".join([*rows, json.dumps(row, ensure_ascii=False)][-keep:]) + "\n", "utf-8")


def export_package(root: str, chunks: DataFrame, vectors: DataFrame, entities: DataFrame, skipped: DataFrame, dim: int, model: str = "hash", stats: dict | None = None, deferred: dict[str, str] | None = None) -> Path:
    """Write a package and move the pointer last, so that a broken run leaves the old one in place."""
    base = Path(root)
    folder = base / f"export_{datetime.now(timezone.utc):%Y%m%d_%H%M%S}"
    folder.mkdir(parents=True, exist_ok=False)
    write_jsonl(chunks, str(folder / "chunks.jsonl"), ["source_path", "chunk_index"])
    write_npy(vectors, str(folder / "vectors.npy"), "chunk_id", dim)
    write_jsonl(entities, str(folder / "entities.jsonl"))
    write_jsonl(skipped, str(folder / "skipped_files.jsonl"))
    m = manifest(chunks, entities, dim, "float16", model, stats)
    (folder / "manifest.json").write_text(json.dumps(m, indent=2, ensure_ascii=False), "utf-8")
    skips = skip_manifest(skipped, deferred)
    (folder / "skip_manifest.json").write_text(json.dumps(skips, indent=2, ensure_ascii=False), "utf-8")
    (folder / "run_report.txt").write_text(run_report(m, skips, stats or {}), "utf-8")
    append_history(base / "run_history.jsonl", {"export": folder.name, "timestamp": m["timestamp"], "chunks": m["chunk_count"]})
    point_latest(base, folder)
    return folder


def copy_verified(files: DataFrame, to_root: str) -> DataFrame:
    """Copy ``files`` (path, rel) below ``to_root``: ``rel, status, bytes``; equal targets are skipped, copies are verified, mtimes kept."""
    ship_package(files.sparkSession)

    def digest(p: str) -> str:
        import hashlib

        with open(p, "rb") as f:
            return hashlib.file_digest(f, "sha256").hexdigest()

    def one(src: str, rel: str) -> tuple[str, int]:
        src, dst = src.removeprefix("file://").removeprefix("file:"), os.path.join(to_root, rel)
        if os.path.relpath(dst, to_root).startswith(".."):
            return "failed", 0
        part = f"{dst}.part"
        try:
            want = digest(src)
            if os.path.exists(dst) and os.path.getsize(dst) == os.path.getsize(src) and digest(dst) == want:
                return "skipped", 0
            os.makedirs(os.path.dirname(dst), exist_ok=True)
            shutil.copy2(src, part)
            if digest(part) != want:
                os.unlink(part)
                return "failed", 0
            os.replace(part, dst)
            return "copied", os.path.getsize(dst)
        except OSError:
            return "failed", 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rel = b.column(1).to_pylist()
            done = [one(s, r) for s, r in zip(b.column(0).to_pylist(), rel, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(rel), pa.array([d[0] for d in done]), pa.array([d[1] for d in done], pa.int64())], ["rel", "status", "bytes"])

    return files.select("path", "rel").mapInArrow(run, "rel string, status string, bytes bigint")


def portable_copy(decisions: DataFrame, from_root: str, to_root: str) -> DataFrame:
    """Copy the canonical sources of a dedup run (path, status) below another root, with verification: ``rel, status, bytes``."""
    chosen = decisions.where("status = 'canonical'").select("path", P.relative_to(F.col("path"), F.lit(from_root)).alias("rel")).dropDuplicates(["rel"])
    return copy_verified(chosen, to_root)


def write_dedup_index(decisions: DataFrame, path: str) -> dict:
    """Decision table partitioned by status, canonical list, duplicate list, and a report with reason counts and reduction."""
    decisions.write.mode("overwrite").partitionBy("status").parquet(f"{path}/decisions")
    decisions.where("status = 'canonical'").select("path").orderBy(F.lower("path")).write.mode("overwrite").text(f"{path}/canonical_files")
    write_jsonl(decisions.where("status = 'duplicate'"), f"{path}/duplicate_files.jsonl")
    by = {r["dedup_reason"]: r["n"] for r in decisions.groupBy("dedup_reason").agg(F.count(F.lit(1)).alias("n")).collect()}
    r = decisions.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == "duplicate").alias("d")).first()
    report = {"files": r["n"], "duplicates": r["d"], "reasons": by, "reduction_pct": round(100.0 * r["d"] / r["n"], 2) if r["n"] else 0.0}
    write_json(report, f"{path}/dedup_report.json")
    return report


def write_json(payload: dict, path: str) -> None:
    p = Path(path.removeprefix("file://"))
    p.parent.mkdir(parents=True, exist_ok=True)
    p.write_text(json.dumps(payload, indent=2, ensure_ascii=False, default=str), "utf-8")


def write_report(df: DataFrame, path: str, title: str, top: int = 200) -> None:
    """A table as JSON lines and CSV, and its first ``top`` rows as Markdown for readers."""
    write_jsonl(df, f"{path}/rows.jsonl")
    df.write.mode("overwrite").option("header", True).csv(f"{path}/rows.csv")
    cell = lambda v: "" if v is None else str(v).replace("|", "\\|").replace("\n", " ")
    lines = [f"# {title}", "", "| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
    lines += ["| " + " | ".join(cell(v) for v in r) + " |" for r in df.limit(top).collect()]
    Path(f"{path.removeprefix('file://')}/report.md").write_text("\n".join(lines) + "\n", "utf-8")


def write_profile(tables: dict[str, DataFrame], path: str, title: str, top: int = 50) -> None:
    """A profile as one JSON file and one Markdown file with a section a table, each cut to its ``top`` rows; whole tables go to JSON lines beside them."""
    folder = Path(path.removeprefix("file://"))
    folder.mkdir(parents=True, exist_ok=True)
    head = {name: [r.asDict(True) for r in df.limit(top).collect()] for name, df in tables.items()}
    for name, df in tables.items():
        write_jsonl(df, f"{path}/{name}.jsonl")
    write_json({"title": title, "generated_at": datetime.now(timezone.utc).isoformat(timespec="seconds"), **head}, f"{path}/profile.json")
    cell = lambda v: "" if v is None else str(v).replace("|", "\\|").replace("\n", " ")
    lines = [f"# {title}"]
    for name, rows in head.items():
        columns = tables[name].columns
        lines += ["", f"## {name}", "", "| " + " | ".join(columns) + " |", "|" + " --- |" * len(columns), *("| " + " | ".join(cell(r[c]) for c in columns) + " |" for r in rows)]
    (folder / "profile.md").write_text("\n".join(lines) + "\n", "utf-8")


def write_delta_report(scanned: DataFrame, moved: DataFrame, path: str) -> dict:
    """Files of a nightly pass: scan rows, transfer rows, the input list of what arrived, and a report of their counts."""
    write_jsonl(scanned, f"{path}/delta_scan.jsonl")
    write_jsonl(moved, f"{path}/transfer.jsonl")
    write_path_list(moved.where("status <> 'failed'"), f"{path}/input_list", "rel")
    kinds = {r["delta_kind"]: r["n"] for r in scanned.groupBy("delta_kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    states = {r["status"]: {"files": r["n"], "bytes": r["b"]} for r in moved.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("b")).collect()}
    report = {"scanned": sum(kinds.values()), "by_kind": kinds, "transfer": states}
    write_json(report, f"{path}/report.json")
    return report


def write_path_list(df: DataFrame, path: str, col: str = "path") -> None:
    """One path a line, distinct and ordered: the input list of a later run."""
    df.select(F.col(col).alias("value")).distinct().orderBy("value").write.mode("overwrite").text(path)
