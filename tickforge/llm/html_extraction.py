"""Main text of pages by the tree-structured model of page_model.

Blocks that the model takes for content are joined in page order by one \\n; in a block,
character references are decoded and white space becomes one space.  Null and empty pages,
and pages without content, give empty text.  A block is content from a marginal of one half
on.  A very long page is held whole, one at a time.  An empty table gives no rows.  Rows are independent: one pass, no shuffle, the
model (a few hundred numbers) goes out with the tasks.  Repeated rows give equal texts;
further columns are not looked at.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .page_model import PageModel, labelled_pages, main_text, train
from .shared import table


def extracted(pages: DataFrame, model: PageModel | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars: code points of text) of every row of pages."""
    model = model or train(labelled_pages())

    def run(batches):
        for batch in batches:
            texts = [main_text(page, model) if page else "" for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], ["page_id", "url", "text", "n_chars"])

    own = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return own.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))
