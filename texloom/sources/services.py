"""Plug-ins for what lies outside the engine: a paper search service and command-line tools.

They are interfaces: where a service or a tool is missing they say so at once.
"""

from __future__ import annotations

import importlib.util
import io
import os
import shutil
import subprocess
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..schema import SEARCH_RESULTS

#: Fetches the records (dicts) of a list of ids; a deployment with a network sets it.
Fetch = Callable[[list[str]], Iterator[dict]]


class PaperSearch(DataSource):
    """spark.read.format("paper_search").option("ids", "a,b").load(): metadata of papers, a partition for every batch of ids."""

    fetch: Fetch | None = None

    @classmethod
    def name(cls) -> str:
        return "paper_search"

    def schema(self) -> str:
        return SEARCH_RESULTS

    def reader(self, schema) -> DataSourceReader:
        return _PaperReader([x for x in self.options.get("ids", "").split(",") if x], int(self.options.get("batch", "100")), type(self).fetch)


class _PaperReader(DataSourceReader):
    def __init__(self, ids: list[str], size: int, fetch: Fetch | None):
        self.ids, self.size, self.fetch = ids, size, fetch

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(self.ids[k : k + self.size]) for k in range(0, len(self.ids), self.size)] or [InputPartition([])]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if not partition.value:
            return
        if self.fetch is None:
            raise RuntimeError("paper_search has no service: set PaperSearch.fetch")
        names = [c.split()[0] for c in SEARCH_RESULTS.split(", ")]
        for r in self.fetch(partition.value):
            yield tuple(r.get(n) for n in names)


#: Tools that the compile and raster stages call.
TOOLS = "pdflatex bibtex latexpand synctex epspdf pdfcrop pdftoppm".split()


def tool_command(tool: str, main: str, extra: str = "") -> list[str]:
    """The command line of a tool for a main file."""
    lines = {
        "pdflatex": ["pdflatex", "-interaction=nonstopmode", "-recorder", *extra.split(), main],
        "bibtex": ["bibtex", *extra.split(), main.removesuffix(".tex")],
        "latexpand": ["latexpand", "--fatal", *extra.split(), main],
        "synctex": ["synctex", main, *extra.split()],
    }
    return lines.get(tool, [tool, *extra.split(), main])


def run_tool(tool: str, main: str, folder: str, extra: str = "", timeout: int = 1000) -> str:
    """Runs a tool in a folder and returns its output; raises if it is not installed, fails or takes too long."""
    if shutil.which(tool) is None:
        raise RuntimeError(f"{tool} is not installed")
    return subprocess.run(tool_command(tool, main, extra), cwd=folder, timeout=timeout, check=True, capture_output=True, text=True, errors="replace").stdout


def compile_commands(variant: str, bibliography: bool = False) -> list[list[str]]:
    """The command lines that make a document's PDF: two passes, three for the coloured one, the last with source places."""
    passes = [tool_command("pdflatex", variant)] * 2
    middle = [tool_command("bibtex", variant)] if bibliography else []
    last = [tool_command("pdflatex", variant, "-synctex=1")] if variant.endswith("paper_colored.tex") else []
    return [passes[0], *middle, passes[1], *last]


def page_renderings(variants: DataFrame, timeout: int = 1000, dpi: int = 72) -> DataFrame:
    """doc_id, name, page_index, content (JPEG), error: every page of each variant (doc_id, name, tex) as an image, a variant at a time.

    A variant that cannot be compiled, or a box without the tools, gives a row with its error.
    """
    schema = "doc_id bigint, name string, page_index int, content binary, error string"

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.int32(), pa.binary(), pa.string()]
        for batch in batches:
            for k in range(batch.num_rows):
                r = batch.slice(k, 1).to_pylist()[0]
                with tempfile.TemporaryDirectory() as folder:  # a tool's working folder; nothing in it outlives the row
                    try:
                        for tool in ("pdflatex", "pdftoppm"):
                            if shutil.which(tool) is None:
                                raise RuntimeError(f"{tool} is not installed")
                        with open(os.path.join(folder, "main.tex"), "w", encoding="utf-8", errors="surrogatepass") as f:
                            f.write(r["tex"] or "")
                        for command in compile_commands("main.tex"):
                            subprocess.run(command, cwd=folder, timeout=timeout, check=True, capture_output=True)
                        subprocess.run(["pdftoppm", "-jpeg", "-r", str(dpi), "main.pdf", "page"], cwd=folder, timeout=timeout, check=True, capture_output=True)
                        rows = []
                        for i, name in enumerate(sorted(x for x in os.listdir(folder) if x.endswith(".jpg"))):
                            with open(os.path.join(folder, name), "rb") as f:
                                rows.append((r["doc_id"], r["name"], i, f.read(), None))
                    except (RuntimeError, subprocess.SubprocessError, OSError) as e:
                        rows = [(r["doc_id"], r["name"], None, None, str(e)[:300])]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 5, kinds, strict=True)], [c.split()[0] for c in schema.split(", ")])

    return variants.select("doc_id", "name", "tex").mapInArrow(render, schema)


def pdf_elements(pdfs: DataFrame) -> DataFrame:
    """doc_id, page_index, kind, x0, y0, x1, y1, page_width, page_height, error: the layout elements of PDFs (doc_id, content).

    Needs a PDF layout library; without it, and for a PDF that cannot be read, a row has the error.
    """
    schema = "doc_id bigint, page_index bigint, kind string, x0 double, y0 double, x1 double, y1 double, page_width double, page_height double, error string"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.string(), *[pa.float64()] * 6, pa.string()]
        for batch in batches:
            for k in range(batch.num_rows):
                r = batch.slice(k, 1).to_pylist()[0]
                try:
                    if importlib.util.find_spec("pdfminer") is None:
                        raise RuntimeError("pdfminer is not installed")
                    from pdfminer.high_level import extract_pages

                    rows = [(r["doc_id"], i, type(e).__name__, *map(float, e.bbox), float(page.width), float(page.height), None) for i, page in enumerate(extract_pages(io.BytesIO(r["content"] or b""))) for e in page]
                except Exception as e:  # noqa: BLE001  what a broken PDF raises is the library's own
                    rows = [(r["doc_id"], *[None] * 8, str(e)[:300])]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 10, kinds, strict=True)], [c.split()[0] for c in schema.split(", ")])

    return pdfs.select("doc_id", "content").mapInArrow(scan, schema)


def source_place(page: int, x: float, y: float, pdf: str, folder: str) -> int:
    """The source line (from 1) of a point of a PDF's page, by the tool that reads its source places."""
    said = run_tool("synctex", "edit", folder, f"-o {page}:{x}:{y}:{pdf}")
    return int(next(line for line in said.splitlines() if line.startswith("Line:")).removeprefix("Line:"))
