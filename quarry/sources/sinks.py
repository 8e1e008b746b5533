"""Sinks: reports, list files, and plans of file actions (dry run by default)."""

from __future__ import annotations

import os
import shutil
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pa_fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import paths
from quarry.tables import Table


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_list(df: DataFrame, path: str, column: str, order: list[str], by: str | None = None) -> None:
    """One value per line in order; with ``by``, a folder per value of it.

    Ranges of the order are written side by side, each sorted: files in order of
    their names are the list.  ``export_list`` makes one file of a small one."""
    keys = [*([by] if by else []), *order]
    rows = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows = rows.select(*([by] if by else []), F.col(column).alias("value"))
    writer = rows.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).text(path)


def export_list(df: DataFrame, path: str, column: str, order: list[str], max_rows: int = 1_000_000) -> None:
    """One list file on the driver, each line ended; refuses more rows than it should hold."""
    rows = df.orderBy(*order).select(F.col(column).cast("string")).limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"more than {max_rows} rows; use write_list")
    with open(path, "w", encoding="utf-8") as out:
        out.writelines(f"{r[0]}\n" for r in rows)


def pruned_list(rows: DataFrame, images: DataFrame) -> DataFrame:
    """List rows in their original spelling, with ``kept`` where the image exists."""
    known = images.select(F.col("path").alias("normalized")).distinct().withColumn("_there", F.lit(True))
    return rows.join(known, "normalized", "left").withColumn("kept", F.coalesce("_there", F.lit(False))).drop("_there")


def rewritten_list(rows: DataFrame, old: str, new: str, suffix: str = "_autodl", overwrite: bool = False) -> DataFrame:
    """``file, output, line_no, line, changed``: each line with its prefix swapped, and
    the file that it goes to: the list itself, or one beside it."""
    path = paths.rewrite_prefix("original", old, new)
    beside = F.regexp_replace("file", r"^(.*?)(\.[^./]*)?$", f"$1{suffix}$2")
    return rows.withColumn("_p", path).select(
        "file", (F.col("file") if overwrite else beside).alias("output"), "line_no", F.col("_p.path").alias("line"), F.col("_p.changed").alias("changed")
    )


def rewrite_counts(lines: DataFrame, examples: int = 5) -> DataFrame:
    """Per file how many lines changed and how many that aren't blank did not, and
    the first that did."""
    first = F.slice(F.sort_array(F.collect_list(F.when(F.col("changed"), F.struct("line_no", "line")))), 1, examples)
    few = lines.where("changed").withColumn("_r", F.row_number().over(Window.partitionBy("file").orderBy("line_no"))).where(F.col("_r") <= examples)
    shown = few.groupBy("file").agg(F.transform(first, lambda x: x["line"]).alias("examples"))
    counts = lines.groupBy("file").agg(
        F.count_if("changed").alias("changed"), F.count_if(~F.col("changed") & (paths.strip("line") != "")).alias("unchanged")
    )
    return counts.join(shown, "file", "left")


def export_small(df: DataFrame, path: str, header: bool = True, bom: bool = True, max_rows: int = 1_000_000) -> None:
    """A single CSV file on the driver with a byte order mark, for spreadsheets;
    refuses more rows than it should hold."""
    rows = df.limit(max_rows + 1).toPandas()
    if len(rows) > max_rows:
        raise ValueError(f"more than {max_rows} rows; use write_csv")
    rows.to_csv(path, index=False, header=header, encoding="utf-8-sig" if bom else "utf-8")


def prediction_lines(pred: DataFrame) -> DataFrame:
    """``image, line`` with 15 tokens: class, confidence, centre, size, angle, corners."""
    corners = [F.format_string("%.3f", F.get("poly", F.lit(i))[a]) for i in range(4) for a in ("x", "y")]
    tokens = [F.col("cls").cast("string"), F.format_string("%.6f", "conf")]
    tokens += [F.format_string("%.3f", c) for c in ("cx", "cy", "w", "h")] + [F.format_string("%.8f", "angle")]
    return pred.select("image", "pred_index", F.concat_ws(" ", *tokens, *corners).alias("line"))


def concat_lines(frames: DataFrame, fps: float) -> DataFrame:
    """``no, line`` of a concat list: each file with its duration, the last file again."""
    per_frame = f"{1 / fps:.12f}"
    quoted = F.concat(F.lit("file '"), F.replace("path", F.lit("'"), F.lit("'\\''")), F.lit("'"))
    pairs = frames.select("no", F.posexplode(F.array(quoted, F.lit(f"duration {per_frame}"))).alias("part", "line"))
    last = frames.orderBy(F.desc("no")).limit(1).select("no", F.lit(2).alias("part"), quoted.alias("line"))
    return pairs.unionByName(last)


def patch_yaml(text: str, train: str, val: str) -> str:
    """The train: and val: lines rewritten, indent kept; appended where absent."""
    lines, seen = [], set()
    for line in text.splitlines():
        key = line.strip().partition(":")[0]
        if key in ("train", "val") and ":" in line:
            seen.add(key)
            line = f"{line[: len(line) - len(line.lstrip())]}{key}: {train if key == 'train' else val}"
        lines.append(line)
    lines += [f"{k}: {v}" for k, v in (("train", train), ("val", val)) if k not in seen]
    return "\n".join(lines) + "\n"


def data_yaml(train: str, val: str, names: dict[int, str]) -> str:
    rows = [f"train: {train}", f"val: {val}", "", "names:"] + [f"  {i}: {names[i]}" for i in sorted(names)]
    return "\n".join(rows) + "\n"


def plan_status(plan: DataFrame, taken: DataFrame) -> DataFrame:
    """A move or copy plan (source, destination, size) against files that exist
    (path, length): already_ok, conflict, missing or ready."""
    at_source = taken.select(F.col("path").alias("source"), F.col("length").alias("source_length"))
    at_goal = taken.select(F.col("path").alias("destination"), F.col("length").alias("goal_length"))
    return plan.join(at_source, "source", "left").join(at_goal, "destination", "left").withColumn(
        "status",
        F.when(F.col("goal_length").isNotNull() & (F.col("source_length").isNull() | (F.col("goal_length") == F.col("source_length"))), "already_ok")
        .when(F.col("goal_length").isNotNull(), "conflict")
        .when(F.col("source_length").isNull(), "missing").otherwise("ready"),
    )


def manifest(entries: DataFrame, files: DataFrame, root: str, require: tuple[str, ...] = ()) -> DataFrame:
    """The move manifest of split entries (split, dataset, relative): where an image
    and its label go, and what becomes of either.

    ``files`` has ``dataset, side (images or labels), at (a split), relative``.  A file
    in its own split is already_ok, one in the other split is to be moved, else it is
    missing; a side in ``require`` that is missing is an error."""
    out = entries.withColumn("_label", paths.swap_suffix("relative"))
    for side, relative in (("images", "relative"), ("labels", "_label")):
        at = files.where(F.col("side") == side).groupBy(
            F.lower("dataset").alias("_d"), F.col("relative").alias("_r")
        ).agg(F.collect_set("at").alias("_at"))
        out = out.join(at, (F.lower("dataset") == F.col("_d")) & (F.col(relative) == F.col("_r")), "left").drop("_d", "_r")
        status = F.when(F.array_contains("_at", F.col("split")), "already_ok").when(F.size("_at") > 0, "moved").otherwise("missing")
        if side in require:
            gone = F.raise_error(F.concat(F.lit(f"{side} missing: "), "dataset", F.lit("/"), relative)).cast("string")
            status = F.when(status == "missing", gone).otherwise(status)
        name = side[:-1]
        out = out.withColumn(f"{name}_status", status).drop("_at").withColumn(
            f"{name}_destination", paths.side_path(root, "dataset", side, "split", relative)
        )
    return out.select(
        "split", "dataset", F.col("relative").alias("relative_image"),
        "image_destination", "image_status", "label_destination", "label_status",
    )


def relocation_plan(images: DataFrame, labels: DataFrame, root: str) -> DataFrame:
    """Moves of labels to where their images are: ``stem, source, destination, status``.
    One label of an image's stem moves; none is missing, several are ambiguous, and
    one that is there already is already_ok."""
    found = labels.groupBy("stem").agg(F.count("*").alias("n"), F.min("path").alias("source"))
    goal = paths.label_of("relative", root)
    return (
        images.select("stem", goal.alias("destination")).join(found, "stem", "left")
        .select(
            "stem", F.when(F.col("n") == 1, F.col("source")).alias("source"), "destination",
            F.when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "ambiguous")
            .when(F.col("source") == F.col("destination"), "already_ok").otherwise("ready").alias("status"),
        )
    )


def backup_plan(files: DataFrame, root: str, backup: str) -> DataFrame:
    """Copies of files to the same place below ``backup``; those from outside of
    ``root`` to its folder _external, by name."""
    inside = F.startswith("path", F.lit(root.rstrip("/") + "/"))
    relative = F.when(inside, F.substr("path", F.lit(len(root.rstrip("/")) + 2))).otherwise(
        F.concat(F.lit("_external/"), F.regexp_extract("path", "([^/]*)$", 1))
    )
    return files.select(
        F.col("path").alias("source"), F.concat(F.lit(backup.rstrip("/") + "/"), relative).alias("destination"), F.lit("ready").alias("status")
    )


def _act(action: str) -> Callable:
    def act(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = []
            for source, goal, status in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if status != "ready":
                    told.append((status, None))
                    continue
                try:
                    told.append((one_action(action, source, goal), None))
                except Exception as problem:  # a row's failure is its result
                    told.append(("failed", str(problem)[:500]))
            yield pa.record_batch(
                [*batch.columns[:2], pa.array([s for s, _ in told], pa.string()), pa.array([e for _, e in told], pa.string())],
                ["source", "destination", "status", "error"],
            )

    return act


def one_action(action: str, source: str, goal: str | None) -> str:
    """Do one thing to one file, on any file system that pyarrow knows; what is done
    already stays done, so that a task may run again."""
    fs, at = pa_fs.FileSystem.from_uri(source) if ":" in source else (pa_fs.LocalFileSystem(), source)
    there = fs.get_file_info(at)
    if action == "delete":
        if there.type == pa_fs.FileType.File:
            fs.delete_file(at)
        return "deleted"
    other, to = pa_fs.FileSystem.from_uri(goal) if ":" in goal else (pa_fs.LocalFileSystem(), goal)
    held = other.get_file_info(to)
    if held.type == pa_fs.FileType.File:
        if there.type != pa_fs.FileType.File or there.size == held.size:
            return "already_ok"
        raise FileExistsError(f"{goal} is another file")
    if there.type != pa_fs.FileType.File:
        raise FileNotFoundError(source)
    other.create_dir(to.rpartition("/")[0], recursive=True)
    local = isinstance(fs, pa_fs.LocalFileSystem) and isinstance(other, pa_fs.LocalFileSystem)
    if action == "link" and local:
        try:
            os.link(at, to)
            return "linked"
        except OSError:
            pass  # another device: copy
    if action == "move" and local:
        shutil.move(at, to)
        return "moved"
    part = f"{to}.part-{os.getpid()}"  # whole files only, whatever becomes of the task
    pa_fs.copy_files(at, part, source_filesystem=fs, destination_filesystem=other)
    other.move(part, to)
    if action == "move":
        fs.delete_file(at)
        return "moved"
    return "copied"


def execute(plan: DataFrame, action: str, dry_run: bool = True, stop_on_error: bool = False) -> DataFrame:
    """Carry out the ready rows of a plan (source, destination, status) on the executors:
    "copy", "link", "move" or "delete".  Returns ``source, destination, status, error``,
    written once; a row that fails says why and others go on, unless
    ``stop_on_error``.  A dry run returns the plan.

    Tasks may run twice: a row whose work is done is done."""
    rows = plan.select("source", "destination", "status")
    if dry_run:
        return rows.withColumn("error", F.lit(None).cast("string"))
    schema = "source string, destination string, status string, error string"
    done = Table(rows.repartition("source").mapInArrow(_act(action), schema), "actions").df
    if stop_on_error:
        failed = done.where("status = 'failed'").limit(5).collect()
        if failed:
            raise OSError("; ".join(f"{r.source}: {r.error}" for r in failed))
    return done


def outcome(done: DataFrame) -> DataFrame:
    """How many rows ended how: ``status, n``."""
    return done.groupBy("status").agg(F.count("*").alias("n"))


def with_failures(records: DataFrame, done: DataFrame, on: str = "path") -> DataFrame:
    """Records with what failed for them added to their reasons; none is lost."""
    why = done.where("status = 'failed'").groupBy(F.col("source").alias(on)).agg(F.min("error").alias("_error"))
    told = F.when(F.col("_error").isNotNull(), F.concat(F.lit("copy failed: "), "_error"))
    joined = paths.joined_reasons(F.array(F.nullif("reasons", F.lit("")), told))
    return records.join(why, on, "left").withColumn("reasons", joined).drop("_error")


def stale_outputs(files: DataFrame, video: str) -> DataFrame:
    """A plan that deletes what an earlier run has saved of a video."""
    named = F.startswith("name", F.lit(f"{video}_img_")) & F.endswith("name", F.lit(".jpg"))
    return files.where(named).select(F.col("path").alias("source"), F.lit(None).cast("string").alias("destination"), F.lit("ready").alias("status"))


def empty_folders(folders: DataFrame, files: DataFrame) -> DataFrame:
    """Folders without a file at any depth, the deepest first: ``folder, depth``."""
    above = F.expr("transform(sequence(1, size(split(path, '/')) - 1), i -> array_join(slice(split(path, '/'), 1, i), '/'))")
    used = files.select(F.explode(above).alias("folder")).distinct()
    depth = F.size(F.split("folder", "/"))
    return folders.join(used, "folder", "left_anti").withColumn("depth", depth).orderBy(F.desc("depth"), "folder")


def remove_empty(root: str) -> int:
    """Remove empty folders below a local root, the deepest first; what can't be
    removed stays.  Returns their number."""
    n = 0
    for folder, _, _ in os.walk(root, topdown=False):
        if folder != root:
            try:
                os.rmdir(folder)
                n += 1
            except OSError:
                continue
    return n


def select_expression(mode: str, every: float) -> str | None:
    """The frame filter of a video tool: each k-th frame, or one that is so many
    seconds after the last selected."""
    if mode == "frame":
        k = max(1, int(every))
        return None if k == 1 else f"select=not(mod(n\\,{k}))"
    if mode == "second":
        if float(every) <= 0:
            raise ValueError("seconds must be above 0")
        return f"select=isnan(prev_selected_t)+gte(t-prev_selected_t\\,{float(every)})"
    raise ValueError(f"unknown mode {mode!r}: frame or second")
