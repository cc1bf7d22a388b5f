"""Main text of web pages by boosted trees over the blocks of the page.

Each page is parsed into a tree of blocks (see html_dom); gradient-boosted
trees score every block from its subtree's density, attribute words, depth and
siblings. Hierarchical decoding then picks the best consistent labelling of
the whole tree: a block can be main text only inside main text, so no choice
contradicts one above or below it. The texts of the chosen leaves, in page
order, are the result. The model is fitted once per driver on labelled pages
made by rule (their number is a parameter) and sent to the tasks.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ledgerlens.llm.common import read_table, small_arrow_batches
from ledgerlens.llm.html_boost import Boosted, labelled_pages
from ledgerlens.llm.html_dom import Node, features, parse

#: Labelled pages the model is fitted on.
TRAINING_PAGES = 1500


def block_labels(nodes: list[Node]) -> np.ndarray:
    """Whether a block is, or holds, main text."""
    held = [n.main and bool(n.text) for n in nodes]
    at = {id(n): k for k, n in enumerate(nodes)}
    for k in range(len(nodes) - 1, 0, -1):
        if held[k]:
            held[at[id(nodes[k].parent)]] = True
    return np.array(held, float)


@lru_cache(maxsize=2)
def fitted(pages: int = TRAINING_PAGES, seed: int = 7) -> Boosted:
    xs, ys = [], []
    for html in labelled_pages(pages, seed):
        nodes = parse(html)
        ys.append(block_labels(nodes))
        xs += features(nodes)
    return Boosted().fit(np.array(xs), np.concatenate(ys))


def decode(nodes: list[Node], score: np.ndarray) -> list[bool]:
    """The most likely labelling in which main blocks have main parents.

    Bottom-up, ``gain`` is how much better the subtree does if its top is
    main (then each child may be either) than if nothing in it is. The page
    itself always counts as main. Ties leave a block out.
    """
    at = {id(n): k for k, n in enumerate(nodes)}
    gain = score.astype(float).tolist()
    for k in range(len(nodes) - 1, 0, -1):
        if gain[k] > 0:
            gain[at[id(nodes[k].parent)]] += gain[k]
    chosen = [True] + [False] * (len(nodes) - 1)
    for k in range(1, len(nodes)):
        chosen[k] = gain[k] > 0 and chosen[at[id(nodes[k].parent)]]
    return chosen


def main_texts(pages: list[str], model: Boosted) -> list[str]:
    trees = [parse(p) for p in pages]
    rows = [features(t) for t in trees]
    scores = model.score(np.array([r for page in rows for r in page]))
    out, at = [], 0
    for nodes in trees:
        chosen = decode(nodes, scores[at:at + len(nodes)])
        at += len(nodes)
        out.append("\n\n".join(n.text for n, c in zip(nodes, chosen) if c and n.text))
    return out


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html",
            training_pages: int = TRAINING_PAGES) -> DataFrame:
    """One row per input row: (id, url, text, n_chars).

    A null or empty body gives the empty text, as does a page without main
    text. Repeated rows are all returned; an empty table gives no rows; other
    columns are ignored. Character references are decoded, white space inside
    a block becomes one space, and blocks are joined by an empty line.
    """
    spark = pages.sparkSession
    small_arrow_batches(spark)
    model = fitted(training_pages)

    @pandas_udf("string")
    def text(bodies: pd.Series) -> pd.Series:
        out: list[str] = []
        for a in range(0, len(bodies), 64):
            out += main_texts(bodies.iloc[a:a + 64].tolist(), model)
        return pd.Series(out, dtype=object)

    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"),
                        F.coalesce(F.col(body_col), F.lit("")).alias("_body"))
    return (rows.withColumn("text", text("_body"))
            .select(F.col("_id").alias(id_col), F.col("_url").alias(url_col), "text",
                    F.length("text").cast("long").alias("n_chars")))


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every whole page of ``pages``."""
    return extract(read_table(spark, sf_dir, "pages"))


QUERIES = {"op3_html_extract": op3_html_extract}
