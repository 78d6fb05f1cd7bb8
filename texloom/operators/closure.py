"""Static dependencies: the files of a project that its roots reach by includes, graphics, bibliographies, classes and styles.

Each command names one file or several, with or without an extension; of the
project's files that a name can stand for, the first by the order of extensions
is meant. Reachability takes as many rounds as the depth has binary digits: a
round joins the reached files with hops of 1, 2, 4 ... steps, and each round is
a table of its own, so no plan grows with the depth. Cycles end, as a round that
reaches nothing new is the last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..sources.rounds import cut

# Commands that name files, the extensions that are tried for each in order, and whether they take a list.
COMMANDS = {
    "include": (r"\\(?:input|include)\{([^}]*)\}", ["", ".tex"], False),
    "import": (r"\\(?:sub)?import\*?\{([^}]*\}\{[^}]*)\}", ["", ".tex"], False),
    "graphics": (r"\\(?:includegraphics\*?(?:\[[^\]]*\])?|psfig|epsfig)\{([^}]*)\}", ["", ".pdf", ".png", ".jpg", ".jpeg", ".eps", ".ps"], False),
    "bibliography": (r"\\(?:bibliography|addbibresource(?:\[[^\]]*\])?)\{([^}]*)\}", ["", ".bib"], True),
    "bibliography style": (r"\\bibliographystyle\{([^}]*)\}", ["", ".bst"], False),
    "class": (r"\\(?:documentclass|LoadClass)(?:\[[^\]]*\])?\{([^}]*)\}", ["", ".cls"], False),
    "style": (r"\\(?:usepackage|RequirePackage)(?:\[[^\]]*\])?\{([^}]*)\}", ["", ".sty"], True),
    "listing": (r"\\lstinputlisting(?:\[[^\]]*\])?\{([^}]*)\}", [""], False),
}


def _plain(name: Column) -> Column:
    """A name without white space at its ends and ./ at its start; {folder}{file} joined."""
    joined = F.regexp_replace(name, r"\s*/?\s*\}\{\s*", "/")
    return F.regexp_replace(F.trim(F.regexp_replace(joined, r"\s+", " ")), r"^(?:\./)+|^/(?=[^/]*$)", "")


def named_files(files: DataFrame) -> DataFrame:
    """doc_id, path, kind, name, extension, rank: what each file may mean by its commands. files: doc_id, path, tex."""
    text = F.regexp_replace("tex", r"(?<!\\)((?:\\\\)*)%[^\n]*", "$1")
    kinds = []
    for kind, (pattern, extensions, listed) in COMMANDS.items():
        names = F.regexp_extract_all("_t", F.lit(pattern), F.lit(1))
        names = F.flatten(F.transform(names, lambda x: F.split(x, ","))) if listed else names
        kinds.append(F.struct(F.lit(kind).alias("kind"), F.array(*map(F.lit, extensions)).alias("extensions"), names.alias("names")))
    rows = files.select("doc_id", "path", text.alias("_t")).select("doc_id", "path", F.explode(F.array(*kinds)).alias("k"))
    rows = rows.select("doc_id", "path", "k.kind", "k.extensions", F.explode(F.array_distinct("k.names")).alias("name"))
    rows = rows.select("doc_id", "path", "kind", _plain(F.col("name")).alias("name"), "extensions").where("name <> ''")
    return rows.select("doc_id", "path", "kind", "name", F.posexplode("extensions").alias("rank", "extension"))


def dependency_edges(files: DataFrame) -> DataFrame:
    """doc_id, path, kind, target: each file of the project that a file names, once a kind."""
    there = files.select("doc_id", F.col("path").alias("target")).distinct()
    tried = named_files(files).withColumn("target", F.concat("name", "extension"))
    found = tried.join(there, ["doc_id", "target"]).groupBy("doc_id", "path", "kind", "name").agg(F.min_by("target", "rank").alias("target"))
    return found.select("doc_id", "path", "kind", "target").distinct()


def reachable(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """doc_id, path of roots (doc_id, path) and of all that they reach by edges (doc_id, path, target). Runs jobs."""
    hop = cut(edges.select("doc_id", "path", "target").where("path <> target").distinct())
    known = cut(roots.select("doc_id", "path").distinct())
    while True:
        # files less than n steps away are known; a hop is n steps
        new = cut(known.join(hop, ["doc_id", "path"]).select("doc_id", F.col("target").alias("path")).distinct().join(known, ["doc_id", "path"], "left_anti"))
        if new.isEmpty():
            return known
        known = cut(known.union(new))
        hop = cut(hop.join(hop.select("doc_id", F.col("path").alias("target"), F.col("target").alias("_next")), ["doc_id", "target"]).select("doc_id", "path", F.col("_next").alias("target")).distinct())


def dependencies(files: DataFrame, roots: DataFrame) -> DataFrame:
    """doc_id, path: the files (doc_id, path, tex) of each project that its roots (doc_id, path) need, themselves included where they exist."""
    return reachable(dependency_edges(files), roots).join(files.select("doc_id", "path").distinct(), ["doc_id", "path"])
