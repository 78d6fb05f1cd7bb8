"""Rows for the needed nodes only, and steps of edits without the documents' texts."""

from pyspark.sql import functions as F

from texloom.operators import edits, parse, tree
from texloom.sources.rounds import cut

TEX = "a \\begin{document}\\begin{table}[h]{\\label{x}} t \\caption[s]{c {\\label{y}}}\\end{table}\\begin{itemize}\\item a\\item b $\\label{z}$\\end{itemize}\\footnote{n \\label{w}}\\end{document}"


def _docs(spark):
    return spark.createDataFrame([(1, TEX), (2, "\\label{only} text"), (3, ""), (4, "\\begin{open}")], "doc_id bigint, tex string")


def _rows(nodes, columns=None):
    return sorted((tuple(r) for r in nodes.select(*(columns or nodes.columns)).collect()), key=repr)


def test_needed_nodes_are_numbered_as_all(spark):
    docs = _docs(spark)
    every = parse.parse_nodes(docs).cache()
    named = every.where("name in ('label', 'caption') or error is not null")
    assert _rows(parse.parse_nodes(docs, names=["label", "caption"])) == _rows(named)
    held = every.alias("n").join(named.select("doc_id", F.col("pre").alias("p")).alias("o"), (F.col("n.doc_id") == F.col("o.doc_id")) & (F.col("n.parent_pre") == F.col("o.p"))).select("n.*")
    assert _rows(parse.parse_nodes(docs, names=["label", "caption"], parts=("arg",))) == _rows(named.union(held.where("slot = 'arg'")).distinct())
    over = every.alias("n").join(named.select("doc_id", F.col("pre").alias("p"), F.col("post").alias("q")).alias("o"), (F.col("n.doc_id") == F.col("o.doc_id")) & (F.expr("n.pre < o.p and n.post > o.q"))).select("n.*")
    assert _rows(parse.parse_nodes(docs, names=["label", "caption"], above=True)) == _rows(named.union(over).distinct())
    some = ["doc_id", "pre", "kind", "text", "char_pos", "error"]
    texts = parse.parse_nodes(docs, kinds=["text"], columns=["pre", "kind", "text", "char_pos"])
    assert texts.columns == some and _rows(texts) == _rows(every.where("kind = 'text' or error is not null"), some)


def test_source_reads_nodes_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    docs = _docs(spark)
    nodes = cut(parse.parse_nodes(docs, names=["label"]))
    found = tree.source(nodes.mapInArrow(counted, nodes.schema), docs).select("doc_id", "source").collect()
    assert sorted(r["source"] for r in found) == ["\\label{only}", "\\label{w}", "\\label{x}", "\\label{y}", "\\label{z}"]
    assert read.value == nodes.count()


def test_steps_of_edits_do_not_carry_the_documents_texts(spark):
    docs = _docs(spark).where("doc_id < 4")
    nodes = cut(parse.parse_nodes(docs, names=["label", "item"], parts=("arg",)))
    labels = nodes.where("name = 'label'").select("doc_id", F.col("pre").cast("bigint").alias("id"))
    seen = []

    def marked(e):
        seen.append(e.where("text <> ''").count())
        return edits.inserted(e, labels.select("doc_id", "id", F.lit("before").alias("place"), F.lit(0).alias("ord"), F.lit("<m>").alias("text")))

    def gone(e):
        seen.append(e.where("text <> ''").count())
        return edits.deleted(e, labels)

    made = edits.source_of(edits.edited(edits.events_of(nodes, docs), [marked, gone]))
    want = {1: TEX, 2: "\\label{only} text"}
    for name in ("x", "y", "z", "w", "only"):
        want = {k: v.replace(f"\\label{{{name}}}", "<m>") for k, v in want.items()}
    assert {r["doc_id"]: r["tex"] for r in made.where("doc_id < 3").collect()} == want
    assert seen == [0, 5]


def test_nodes_parsed_with_their_sources_do_not_read_the_documents_again(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    docs = spark.createDataFrame([*_docs(spark).collect(), (5, "é\\caption[s]{\U0001d54f{y}} \\caption{z}")], "doc_id bigint, tex string")
    once = docs.mapInArrow(counted, docs.schema)
    nodes = cut(parse.parse_nodes(once, names=["caption"], parts=("arg",), sources=("arg",)))
    assert nodes.columns[-3:] == ["char_end", "source", "error"] and read.value == docs.count()
    plain = parse.parse_nodes(docs, names=["caption"], parts=("arg",))
    assert _rows(tree.arguments(nodes, once)) == _rows(tree.arguments(plain, docs)) and read.value == docs.count()
    assert {r["source"] for r in nodes.where("slot = 'arg' or source is not null").collect()} == {"[s]", "{c {\\label{y}}}", "{\U0001d54f{y}}", "{z}"}
    assert _rows(tree.source(nodes.where("slot = 'arg'"), once)) == _rows(tree.source(plain.where("slot = 'arg'"), docs))
