"""Include resolution: files are spliced into those that name them, project by project, and round by round where a project is large."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..sources.rounds import cut, new_folder

#: Characters of a project, with FILE for each file, up to which one task holds it.
LARGE, FILE = 8 << 20, 64

PATTERN = r"\\(?:subimport|import)\*?\{[^}]*\}\{[^}]*\}|\\(?:include|input)\{[^}]*\}"


def _target(command: Column) -> Column:
    """The path that a command names, with .tex."""
    folder = F.regexp_extract(command, r"import\*?\{([^}]*)\}\{", 1)
    name = F.regexp_extract(command, r"\{([^}]*)\}$", 1)
    path = F.when(folder == "", name).otherwise(F.concat(F.regexp_replace(folder, "/$", ""), F.lit("/"), name))
    return F.when(F.endswith(path, F.lit(".tex")), path).otherwise(F.concat(path, F.lit(".tex")))


def include_edges(files: DataFrame) -> DataFrame:
    """doc_id, path, seq, command, target of every include. files: doc_id, path, tex."""
    rows = files.select("doc_id", "path", F.posexplode(F.regexp_extract_all("tex", F.lit(PATTERN), F.lit(0))).alias("seq", "command"))
    return rows.select("doc_id", "path", F.col("seq").cast("long").alias("seq"), "command", _target(F.col("command")).alias("target"))


def _pieces(files: DataFrame) -> DataFrame:
    """doc_id, path, pieces: each file as an array of (text, command, target) in order; command is null in the last."""
    gaps, commands = F.split("tex", PATTERN, -1), F.regexp_extract_all("tex", F.lit(PATTERN), F.lit(0))
    piece = F.transform(F.arrays_zip(gaps.alias("t"), commands.alias("c")), lambda p: F.struct(p["t"].alias("text"), p["c"].alias("command"), _target(p["c"]).alias("target")))
    return files.select("doc_id", "path", piece.alias("pieces"))


def _in_rounds(files: DataFrame, roots: DataFrame) -> DataFrame:
    """resolved() for projects of any size.

    A round joins the open includes, and nothing else, with the files that they name. What a round finds is written once: texts that
    are in place go to one table and are not touched again, and the next round reads what is still open. Runs jobs.
    """
    known = _pieces(files.groupBy("doc_id", "path").agg(F.min("tex").alias("tex")))
    row = ["doc_id", "path", "key", "text", "command", "target", "above"]

    def opened(rows: DataFrame) -> DataFrame:
        """A row for each piece: key is its place, above the files that it stands in."""
        return rows.select("doc_id", "path", "key", "above", F.posexplode("pieces").alias("k", "p")).select("doc_id", "path", F.array_append("key", F.col("k")).alias("key"), "p.text", "p.command", "p.target", "above").select(row)

    named = known.select("doc_id", F.col("path").alias("target"), "pieces")
    first = roots.select("doc_id", "path").distinct().join(known, ["doc_id", "path"])
    inner = opened(first.select("doc_id", "path", F.array().cast("array<int>").alias("key"), F.array("path").alias("above"), "pieces"))
    spark, folder, rounds = files.sparkSession, new_folder(files.sparkSession), 0
    while True:
        # the text of a piece is in place; what its command names comes behind it
        joined = inner.join(named, ["doc_id", "target"], "left")
        joined = joined.withColumn("open", F.col("command").isNotNull() & F.col("pieces").isNotNull() & ~F.array_contains("above", F.col("target")))
        kept = joined.select("doc_id", "path", "key", "text", F.when(~F.col("open"), F.col("command")).alias("stays"), F.when(F.col("open"), F.struct(F.array_append("above", F.col("target")).alias("above"), "pieces")).alias("next"), F.col("open").alias("goes_on"))
        kept.write.parquet(f"{folder}/round={rounds}")
        state = spark.read.schema(kept.schema).parquet(f"{folder}/round={rounds}")
        rounds += 1
        todo = state.where("goes_on")
        if todo.isEmpty():
            break
        inner = opened(todo.select("doc_id", "path", F.array_append("key", F.lit(1)).alias("key"), "next.above", "next.pieces"))
    pieces = spark.read.schema(kept.schema).parquet(*(f"{folder}/round={k}" for k in range(rounds)))
    both = F.array(F.struct(F.array_append("key", F.lit(0)).alias("key"), F.coalesce("text", F.lit("")).alias("t")), F.struct(F.array_append("key", F.lit(1)).alias("key"), F.col("stays").alias("t")))
    done = pieces.select("doc_id", "path", F.explode(both).alias("x")).where("x.t is not null")
    return done.groupBy("doc_id", "path").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["t"]), "").alias("tex"))


def _spliced(project: dict[str, tuple[list, list, list]], root: str) -> str:
    """The text of a root; project has the texts between commands, commands and targets of each path."""
    out, above, stack = [], {root}, [(root, 0)]
    while stack:
        path, k = stack.pop()
        gaps, commands, targets = project[path]
        out.append(gaps[k])
        if k == len(commands):
            above.remove(path)
            continue
        stack.append((path, k + 1))
        if targets[k] in project and targets[k] not in above:
            above.add(targets[k])
            stack.append((targets[k], 0))
        else:
            out.append(commands[k])
    return "".join(out)


def _by_project(files: DataFrame, roots: DataFrame) -> DataFrame:
    """resolved() for projects that a task can hold: their rows stand together, the roots' behind those of the files."""
    of_files = files.where("tex is not null").select("doc_id", "path", F.lit(0).alias("side"), "tex")
    rows = of_files.unionByName(roots.select("doc_id", "path", F.lit(1).alias("side"), F.lit(None).cast("string").alias("tex"))).where("doc_id is not null and path is not null")
    together = rows.repartition("doc_id").sortWithinPartitions("doc_id", "side", "path", "tex")
    gaps, commands = F.split("tex", PATTERN, -1), F.regexp_extract_all("tex", F.lit(PATTERN), F.lit(0))
    lists = ["gaps", "commands", "targets"]

    def batch_of(out: list[tuple], doc_id: pa.DataType) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), (doc_id, pa.string(), pa.string()), strict=True)], ["doc_id", "path", "tex"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, project, last = None, {}, None
        for batch in batches:
            out, held, kind = [], 0, batch.schema.field("doc_id").type
            parts = [(batch.column(c).offsets.to_pylist(), batch.column(c).values.to_pylist()) for c in lists]
            for i, (doc_id, path, side) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("doc_id", "path", "side")), strict=True)):
                if doc_id != now:
                    now, project, last = doc_id, {}, None
                if side == 0:  # of files of one path the first counts
                    project.setdefault(path, tuple(values[at[i] : at[i + 1]] for at, values in parts))
                elif path in project and path != last:
                    last = path
                    out.append((doc_id, path, _spliced(project, path)))
                    held += len(out[-1][2])
                    if held > LARGE:
                        yield batch_of(out, kind)
                        out, held = [], 0
            if out:
                yield batch_of(out, kind)

    pieces = together.select("doc_id", "path", "side", gaps.alias("gaps"), commands.alias("commands"), F.transform(commands, _target).alias("targets"))
    return pieces.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, path string, tex string")


def resolved(files: DataFrame, roots: DataFrame) -> DataFrame:
    """doc_id, path, tex of roots (doc_id, path) with includes in place, however deep. Those that name no file stay, and so do
    those that name a file they stand in, at any distance: a cycle is entered once. Of files of one path that with the smallest text counts.

    Projects of up to LARGE characters are resolved where their files meet after one shuffle, those above it in rounds. Runs jobs.
    """
    size = F.sum(F.coalesce(F.length("tex"), F.lit(0)).cast("bigint") + F.length("path") + FILE)
    large = cut(files.groupBy("doc_id").agg(size.alias("size")).where(F.col("size") > LARGE).select("doc_id"), "large")
    if large.isEmpty():
        return _by_project(files, roots)
    held = lambda rows, how: rows.join(large, "doc_id", how)
    return _by_project(held(files, "left_anti"), held(roots, "left_anti")).unionByName(_in_rounds(held(files, "left_semi"), held(roots, "left_semi")))
