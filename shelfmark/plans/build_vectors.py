"""Job: taxonomy documents to a searchable corpus."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark import fixed
from shelfmark.operators.embedding import embed
from shelfmark.operators.tree import flatten_tree
from shelfmark.session import fingerprint, materialize, materialize_in_waves, open_run, run_folder
from shelfmark.sources.corpus import load_corpus, save_corpus
from shelfmark.sources.taxonomy import top_nodes

CORPUS_COLUMNS = [
    "position", "id", "text", "level", "code", "title", "hierarchy_path",
    "hierarchy_string", "definition", "excludes", "active", "source", "embedding",
]


def build_vectors(documents: DataFrame, folder: str, make_provider: Callable, dimensions: int,
                  model: str = "unknown", prefix: str = "gs1",
                  lookup_fields: Sequence[str] = fixed.LOOKUP_FIELDS,
                  key: str = "document", spread: int | None = None,
                  call_partitions: int | None = None, run: str | None = None, waves: int = 1,
                  resume: bool = False) -> tuple[DataFrame, DataFrame]:
    """Flatten, embed, save and check; returns corpus and lookup as saved.

    ``documents`` are taxonomy texts (``read_taxonomy``) or top-level nodes
    (``scan_nodes``). ``spread`` distributes the nodes of few big documents,
    ``call_partitions`` sets how many tasks call the embedding provider at once.

    With a ``run`` folder the embedded nodes are committed there in ``waves``:
    a build that broke off goes on with the same ``run`` and ``resume``, repeats
    no call of a finished wave, and refuses other documents or settings. Without
    it, and in one wave, they go right into the corpus: there is nothing to resume.
    """
    spark = documents.sparkSession
    top = documents if "node" in documents.columns else top_nodes(documents, key)
    place = run or run_folder(spark)
    if run:
        shown = documents.withColumn("node", F.to_json("node")) if "node" in documents.columns else documents
        open_run(spark, place, resume, {
            "job": "build_vectors", "key": key, "dimensions": dimensions, "model": model, "waves": waves,
            "documents": fingerprint(shown)})
    def embedded(part: DataFrame) -> DataFrame:
        part = part.repartition(call_partitions) if call_partitions else part
        vector = embed(F.col("text"), make_provider, dimensions=dimensions)
        return part.withColumn("embedding", vector).select(*CORPUS_COLUMNS)

    if run or waves > 1:
        nodes = materialize(lambda: flatten_tree(top, key, spread, place), "flat-nodes", place, resume)
        corpus = materialize_in_waves(nodes, "position", embedded, "vectors", place, waves, resume)
    else:
        corpus = embedded(flatten_tree(top, key, spread, place))
    save_corpus(corpus, folder, model, prefix, lookup_fields, dimensions)
    return load_corpus(spark, folder, model, dimensions)
