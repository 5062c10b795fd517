"""Cited documents: reference lists, citation checks and repairs, rendering.

References are few once they are cited; lists are sorted by Spark and rendered
on the driver.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from biblion.functions import text as X

REFERENCE = ["paper_id", "title", "year", "authors", "doi"]
_CITED = re.compile(r"\(([^()]+?), (\d{4})\)")
# What LaTeX needs escaped.
LATEX = {"\\": r"\textbackslash{}", "&": r"\&", "%": r"\%", "$": r"\$", "#": r"\#", "_": r"\_", "{": r"\{", "}": r"\}", "~": r"\textasciitilde{}", "^": r"\textasciicircum{}"}


def citable(df: DataFrame) -> DataFrame:
    """Rows with all that a reference needs."""
    test = F.lit(True)
    for c in REFERENCE:
        test = test & (X.clean_whitespace(F.col(c)) != "")
    return df.filter(test & F.col("year").rlike(r"^\s*\d{4}\s*$"))


def references(df: DataFrame, cited: Sequence[str] = ()) -> DataFrame:
    """One row a paper with its label, sorted by label, year and title; the cited ones only, if any is."""
    rows = df.filter(F.col("paper_id").isin(list(cited))) if cited else df
    best = rows.groupBy("paper_id").agg(F.min(F.struct("title", "year", "authors", "doi")).alias("r")).select("paper_id", "r.*")
    label = X.author_label(F.col("authors"))
    return best.withColumn("label", label).orderBy(F.lower("label"), F.lower("year"), F.lower("title"), "paper_id")


def section_papers(sections: DataFrame, papers: DataFrame) -> DataFrame:
    """section_id, at and the columns of each citable paper of a section (paper_ids), in the section's order."""
    rows = sections.select("section_id", F.posexplode("paper_ids").alias("at", "paper_id"))
    known = citable(papers).dropDuplicates(["paper_id"])
    return rows.join(known, "paper_id").orderBy("section_id", "at")


def edited_sections(drafts: DataFrame, edited: DataFrame) -> DataFrame:
    """The edited sections (section_id, text); an id that either side lacks is an error."""
    both = drafts.select("section_id", F.lit(True).alias("drafted")).join(edited.select("section_id", F.struct("text").alias("told")), "section_id", "full")
    said = F.concat(F.lit("editing lost or added section "), "section_id")
    wrong = F.col("drafted").isNull() | F.col("told").isNull()
    return both.select("section_id", F.when(wrong, F.raise_error(said).cast("string")).otherwise(F.col("told.text")).alias("text"))


def repaired(text: str, papers: Sequence[dict]) -> str:
    """A citation that no paper has is replaced if one paper alone has its year; else it is an error."""
    known = {(p["label"], p["year"]) for p in papers}

    def fix(found: re.Match) -> str:
        parts = []
        for part in found[0][1:-1].split("; "):
            one = re.fullmatch(r"(.+), (\d{4})", part)
            if not one or (one[1], one[2]) in known:
                parts.append(part)
                continue
            same = [p for p in papers if p["year"] == one[2]]
            if len(same) != 1:
                raise ValueError(f"unknown citation: {part}")
            parts.append(f"{same[0]['label']}, {one[2]}")
        return "(" + "; ".join(parts) + ")"

    return re.sub(r"\([^()]*, \d{4}\)", fix, text)


def coverage_gaps(text: str, papers: Sequence[dict]) -> list[str]:
    """Ids of papers that a text doesn't cite, sorted."""
    told = {(a, y) for a, y in _CITED.findall(text.replace("; ", ") ("))}
    return sorted(p["paper_id"] for p in papers if (p["label"], p["year"]) not in told)


def reference_line(p: dict) -> str:
    return f"{p['authors']} ({p['year']}). {p['title']}. https://doi.org/{p['doi']}"


def markdown(title: str, sections: Sequence[tuple[str, str]], papers: Sequence[dict]) -> str:
    parts = [f"# {title}", *(f"## {heading}\n\n{body}" for heading, body in sections), "## References\n\n" + "\n".join(f"- {reference_line(p)}" for p in papers)]
    return "\n\n".join(parts) + "\n"


def latex_escaped(text: str) -> str:
    return "".join(LATEX.get(c, c) for c in text)


def latex(title: str, sections: Sequence[tuple[str, str]], papers: Sequence[dict]) -> str:
    """Citations become keys, the longest label first so that none hides within another."""
    def body(text: str) -> str:
        out = latex_escaped(text)
        for p in sorted(papers, key=lambda p: (-len(p["label"]), p["paper_id"])):
            out = out.replace(latex_escaped(f"({p['label']}, {p['year']})"), f"\\citep{{{p['paper_id']}}}")
        return out

    parts = [f"\\section{{{latex_escaped(heading)}}}\n{body(text)}" for heading, text in sections]
    return "\\documentclass{article}\n\\usepackage{natbib}\n\\title{" + latex_escaped(title) + "}\n\\begin{document}\n\\maketitle\n" + "\n\n".join(parts) + "\n\\bibliographystyle{plainnat}\n\\bibliography{references}\n\\end{document}\n"


def bibtex(papers: Sequence[dict]) -> str:
    def entry(p: dict) -> str:
        fields = {"title": p["title"], "author": " and ".join(p["authors"].split("; ")), "year": p["year"], "doi": p["doi"]}
        return f"@article{{{p['paper_id']},\n" + ",\n".join(f"  {k} = {{{latex_escaped(v)}}}" for k, v in fields.items()) + "\n}\n"

    return "\n".join(map(entry, papers))
