"""Corpus jobs: term counts, lemmas and TF-IDF of all messages.

The text is tokenised once. Counts per document and form, the lemma table, the
counts per lemma and the document frequencies are written to the shared folder
in turn, so that each later step starts from a table whose size the optimizer
knows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import terms
from tidemark.sources import stored


def corpus_terms(tokenised: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(term counts per document, lemmas by the corpus's own vocabulary)."""
    counts = stored(terms.term_counts(terms.exploded(tokenised)), "term-counts")
    return counts, stored(terms.noun_lemmas(counts), "lemmas")


def lemmatised(tokenised: DataFrame, lower_after: bool = False) -> DataFrame:
    """Token lists with lemmas by the corpus's own vocabulary."""
    lemmas = stored(terms.noun_lemmas(terms.vocabulary(tokenised)), "lemmas")
    return terms.lemmatise(tokenised, lemmas, lower_after=lower_after)


def message_tfidf(tokenised: DataFrame, documents: DataFrame | None = None) -> DataFrame:
    """TF-IDF weights of lemmas; ``documents`` may be a cheaper table with the same rows."""
    forms, lemmas = corpus_terms(tokenised)
    counts = stored(terms.lemma_counts(forms, lemmas), "lemma-counts")
    # Most terms of a large corpus are in one document; they need not be looked up.
    shared = terms.document_frequency(counts).filter(F.col("df") > 1)
    frequencies = stored(shared, "document-frequency")
    return terms.tfidf(counts, tokenised if documents is None else documents, frequencies, others_once=True)
