"""Writers: delimited tables, parameters, plot documents, a plain HTML report."""

from __future__ import annotations

import json
from html import escape
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, sep: str = ",", quote_all: bool = False) -> None:
    df.write.csv(path, sep=sep, header=True, quoteAll=quote_all, emptyValue="", nullValue="", mode="overwrite")


def write_annotated(df: DataFrame, path: str) -> None:
    """Every field quoted."""
    write_csv(df, path, quote_all=True)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Floats to ``digits`` places, half to even."""
    return df.select(*[F.bround(c, digits).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes])


def write_diagnostics(df: DataFrame, path: str) -> None:
    write_csv(rounded(df), path)


def consensus_metadata(consensus: DataFrame) -> DataFrame:
    """The sidecar that goes with the FASTA of a consensus."""
    return consensus.select("consensus_group", "cluster_id", "n_reference")


def write_parameters(parameters: dict, path: str) -> None:
    Path(path).write_text(json.dumps(parameters, indent=2) + "\n")


def write_documents(df: DataFrame, path: str) -> None:
    """Each row as a line of JSON."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode("overwrite").text(path)


def html_table(df: DataFrame, max_rows: int = 100) -> str:
    """A table of at most ``max_rows`` rows, as the report shows them."""
    rows = df.limit(max_rows).collect()
    head = "".join(f"<th>{escape(c)}</th>" for c in df.columns)
    body = "".join("<tr>" + "".join(f"<td>{escape('' if v is None else str(v))}</td>" for v in r) + "</tr>" for r in rows)
    return f"<table><thead><tr>{head}</tr></thead><tbody>{body}</tbody></table>"


def html_report(title: str, sections: dict[str, DataFrame | str], path: str, max_rows: int = 50) -> None:
    """One page with a heading and a table or a text per section."""
    parts = [f"<h2>{escape(k)}</h2>" + (f"<p>{escape(v)}</p>" if isinstance(v, str) else html_table(v, max_rows)) for k, v in sections.items()]
    Path(path).write_text(f"<!DOCTYPE html><html><head><meta charset='utf-8'><title>{escape(title)}</title></head><body><h1>{escape(title)}</h1>{''.join(parts)}</body></html>\n", encoding="utf-8")


def make_folders(base: str, names: tuple[str, ...] = ("dereplication", "genotype_assignments", "taxonomy", "geographic", "phylogenetic", "visualization", "reports")) -> dict[str, Path]:
    out = {n: Path(base) / n for n in names}
    for p in out.values():
        p.mkdir(parents=True, exist_ok=True)
    return out


def prune_empty(base: str) -> int:
    """Removes empty folders below ``base``, deepest first."""
    n = 0
    for p in sorted(Path(base).rglob("*"), key=lambda p: -len(p.parts)):
        if p.is_dir() and not any(p.iterdir()):
            p.rmdir()
            n += 1
    return n
