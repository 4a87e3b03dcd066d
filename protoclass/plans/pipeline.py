"""The whole job as one composition of operators: prepare -> fit -> score ->
assign -> evaluate.

Scalars that steer the physical plan (corpus size, topic count, the hot-term
threshold) are computed once by small aggregates and passed on as literals;
every relation stays distributed.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import STOP_WORDS
from ..operators import centroid as C
from ..operators import evaluate as E
from ..operators import labels as L
from ..operators import routing as R
from ..operators import scoring as S
from ..operators import terms as T
from ..operators import weights as W
from ..operators.lookup import (DEFAULT_MAX_BROADCAST_BYTES, DEFAULT_TASK_ROWS, SplitPlan, plan_split, split_plan_of,
                               string_bytes)
from ..session import materialize


@dataclass(frozen=True)
class Config:
    """Knobs of a run.

    profile: tokeniser profile (``word`` or ``ascii``).
    df_scope: ``all`` counts N and df over TRAIN and TEST documents, like the
      reference; ``train`` over training documents only.
    exact: accumulate dot products and norms as DECIMAL(38,0) (else DOUBLE).
    max_broadcast_bytes: byte budget of a broadcast term- or topic-keyed table.
    task_rows: postings of one term that one task of a shuffled term join gets.
    topic_block: topics in a block of the centroid matrix.
    prune: find the nearest topic by bounds instead of scoring all topics (the
      result is the same); None does so if there is more than one block, for
      within one block a document's sums are one row either way.
    tail_share: terms that more than this share of the topics hold are left
      out of the first pass of a pruned search.
    keep: how shared intermediates are kept (``persist``/``checkpoint``/``none``).
    order: columns that order copies of a document id (last wins); copies that
      tie in them are ordered by a hash of their content.
    unique_order: no two copies tie in ``order`` (it ends in the place of a row
      in its source); de-duplication then reads its input twice, else three times.
    rebalance: None = spread documents only when the source is small (see
      ``balance``); True/False forces it.
    max_token_length: longer tokens are dropped (255 in the analyser whose
      results the defaults match otherwise); None keeps every token.
    """

    profile: str = "word"
    stop_words: tuple[str, ...] = STOP_WORDS
    df_scope: str = "all"
    exact: bool = True
    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES
    task_rows: int = DEFAULT_TASK_ROWS
    topic_block: int = 16
    prune: bool | None = None
    tail_share: float = 0.5
    keep: str = "persist"
    order: tuple[str, ...] = ("old_id",)
    unique_order: bool = False
    rebalance: bool | None = None
    max_token_length: int | None = None


CONTENT = "_content"   # hash of a document's columns, last in the reading order


@dataclass
class Prepared:
    """Kept documents and their per-document term counts."""

    docs: DataFrame        # doc_id, old_id, split, title, body, topics (+ source columns)
    doc_terms: DataFrame   # doc_id, split, topics, tfs, n_terms
    config: Config
    _kept: list = field(default_factory=list)

    def term_freq(self) -> DataFrame:
        return T.term_freq(self.doc_terms)

    def edges(self) -> DataFrame:
        return L.doc_topics(self.doc_terms)

    def test_docs(self) -> DataFrame:
        return R.test_documents(self.doc_terms).select("doc_id", L.clean_topics("topics").alias("topics"))

    def close(self) -> None:
        for df in self._kept:
            df.unpersist()


def prepare(corpus: DataFrame, config: Config = Config()) -> Prepared:
    """C1 + C2, then E1-E3 per document, then C5 on the per-document counts.

    The source text is scanned once: last-wins de-duplication needs only the
    id and the reading order, which travel with the (kept) term counts, so
    duplicates are found and dropped there instead of in a second pass over
    the text. Tokenising a losing copy is the only work wasted on it. A hash of
    the content ends the order, so that documents and term counts agree on the
    winner among copies that tie in it.
    """
    routed = R.drop_empty_bodies(R.route_splits(corpus))
    order = list(config.order)
    if not config.unique_order:
        routed = routed.withColumn(CONTENT, F.xxhash64(*routed.columns))
        order.append(CONTENT)
    spread = routed   # for the tokeniser; the documents are read as they stand
    if config.rebalance is None:
        # copies of one id are spread by their reading order, so a hot id
        # cannot land in a single partition
        spread = R.balance(routed, ["doc_id", *order])
    elif config.rebalance:
        spread = routed.repartition(routed.sparkSession.sparkContext.defaultParallelism, "doc_id", *order)
    counted = materialize(
        T.doc_terms(spread, config.profile, config.stop_words, keep=("doc_id", "split", "topics", *order),
                    max_token_length=config.max_token_length),
        config.keep)
    dterms = materialize(R.dedup_last(counted, order=order, unique=config.unique_order), config.keep)
    docs = R.dedup_last(routed, order=order, unique=config.unique_order).drop(CONTENT)
    return Prepared(docs, dterms, config, [counted, dterms])


@dataclass
class CentroidModel:
    """A fitted nearest-centroid model (all relations distributed)."""

    n_docs: int
    factors: DataFrame       # term, df, q
    sums: DataFrame          # topic, term, sw
    vocabulary: DataFrame    # topic, n_train
    topic_norms: DataFrame   # topic, n2
    n_topics: int            # of the vocabulary
    n_defined: int           # with a non-empty centroid
    topic_bytes: int         # of a topic-keyed table
    default_topic: str | None
    index: DataFrame         # topic, no, n2, root
    table: DataFrame         # term, df, q, block, entries, most, own (the score table)
    tail: DataFrame | None   # term, df, q, block, entries of terms that most topics hold
    factor_plan: SplitPlan
    score_plan: SplitPlan
    tail_plan: SplitPlan | None
    config: Config
    _kept: list = field(default_factory=list)

    @property
    def slots(self) -> int:
        return C.slots_of(self.config.topic_block, self.n_defined)

    @property
    def n_blocks(self) -> int:
        return -(-self.n_defined // self.config.topic_block)

    def centroids(self) -> DataFrame:
        return C.centroids(self.sums, self.vocabulary, self.topic_bytes, self.config.max_broadcast_bytes)

    def topic_blocks(self) -> DataFrame:
        return C.small(C.topic_blocks(self.index, self.config.topic_block), self.topic_bytes, self.config.max_broadcast_bytes)

    def weigh(self, postings: DataFrame) -> DataFrame:
        """E6 + E7: ``df``, ``q``, ``w`` of every posting whose term is known."""
        return W.weigh(postings, self.factors, plan=self.factor_plan)

    def score(self, doc_terms: DataFrame) -> "Scored":
        return Scored(self, T.term_freq(doc_terms, extra=()))

    def close(self) -> None:
        for df in self._kept:
            df.unpersist()


class Scored:
    """Documents against a model: nearest topics, and pairs where a caller asks for them."""

    def __init__(self, model: CentroidModel, postings: DataFrame):
        self.model, self.postings = model, postings
        self._blocks: DataFrame | None = None
        self._kept: list[DataFrame] = []

    def _sums(self, table: DataFrame) -> DataFrame:
        weighted = W.weigh(self.postings, table, plan=self.model.score_plan)
        return S.doc_block_sums(weighted, self.model.slots, self.model.n_blocks, self.model.config.exact)

    def blocks(self) -> DataFrame:
        """Full sums by (document, block of topics); computed once and kept."""
        if self._blocks is None:
            m = self.model
            table = m.table
            if m.tail is not None:   # the whole matrix, not the one of the pruned search
                table = C.score_tables(m.factors, C.blocked_entries(m.sums, _index(m), m.config.topic_block, m.n_defined), m.n_defined, m.n_blocks)[0]
            self._blocks = self._keep(self._sums(table))
        return self._blocks

    def _keep(self, df: DataFrame) -> DataFrame:
        self._kept.append(materialize(df, self.model.config.keep))
        return self._kept[-1]

    @property
    def sims(self) -> DataFrame:
        """the similarities of the pairs that share a term."""
        return S.similarities(self.blocks(), self.model.topic_blocks(), self.model.slots)

    def top(self, k: int) -> DataFrame:
        """The ``k`` nearest topics of each document, with their ranks."""
        return S.rank_topics(S.similarities(self.blocks(), self.model.topic_blocks(), self.model.slots, k), k)

    def near(self) -> DataFrame:
        """``(doc_id, topic, sim, candidates)``; no pair is kept. Of a
        pruned search the first pass is."""
        m = self.model
        if m.tail is None:
            blocks = (self._blocks if self._blocks is not None else self._sums(m.table)).withColumn("candidates", F.lit(m.n_defined))
        else:
            blocks = S.pruned_blocks(self._sums(m.table), m.topic_blocks(), m.slots, m.n_defined, m.n_blocks,
                                     self.postings, m.tail, m.tail_plan, m.config.exact, keep=self._keep)
        return S.nearest(blocks, m.topic_blocks(), m.slots, m.n_blocks)

    def close(self) -> None:
        for df in self._kept:
            df.unpersist()


def fit(prepared: Prepared, config: Config | None = None) -> CentroidModel:
    """Corpus statistics, weights, centroid sums, norms."""
    cfg = config or prepared.config
    dterms = prepared.doc_terms
    indexed = dterms if cfg.df_scope == "all" else R.train_documents(dterms)
    if cfg.df_scope not in ("all", "train"):
        raise ValueError(f"df_scope must be 'all' or 'train', not {cfg.df_scope!r}")
    n_docs = int(T.corpus_size(indexed).first()["n_docs"])
    factors = materialize(W.idf_factor(T.term_stats(indexed), n_docs), cfg.keep)
    sums = materialize(C.centroid_sums(R.train_documents(dterms), factors), cfg.keep)
    vocab = materialize(L.topic_vocabulary(dterms), cfg.keep)
    tnorms = materialize(C.topic_norms(sums, cfg.exact), cfg.keep)
    return model_of(n_docs, factors, sums, vocab, tnorms, cfg, [factors, sums, vocab, tnorms])


def model_of(n_docs: int, factors: DataFrame, sums: DataFrame, vocab: DataFrame, tnorms: DataFrame, cfg: Config, kept: list) -> CentroidModel:
    """The model over fitted (or loaded) relations: counts and sizes are
    measured, topics numbered, the score table and its joins laid out."""
    has = F.col("n2") > 0
    row = (vocab.join(tnorms, "topic", "left")
           .agg(F.count(F.lit(1)).alias("n"), F.count_if(has).alias("defined"), F.min(F.when(has, F.col("topic"))).alias("first"),
                F.sum(C.topic_row_bytes(F.col("topic"))).alias("bytes"))
           .first())
    n_topics, n_defined, topic_bytes = int(row["n"]), int(row["defined"]), int(row["bytes"] or 0)
    index = C.topic_index(tnorms, topic_bytes, cfg.max_broadcast_bytes)
    n_blocks = -(-n_defined // cfg.topic_block)
    pruned = n_blocks > 1 if cfg.prune is None else cfg.prune
    if n_blocks > 1:   # several plans number and block the topics
        index = materialize(index, cfg.keep)
        kept.append(index)
    entries = C.blocked_entries(sums, C.small(index, topic_bytes, cfg.max_broadcast_bytes), cfg.topic_block, n_defined)
    if pruned:
        entries = materialize(entries, cfg.keep)
        kept.append(entries)
    table, tail = C.score_tables(factors, entries, n_defined, n_blocks, cfg.tail_share if pruned else None)
    total_df, factor_bytes, score_bytes = C.table_sizes(factors, sums, cfg.topic_block, n_defined)
    factor_plan = split_plan_of(total_df, factor_bytes, cfg.max_broadcast_bytes, cfg.task_rows)
    score_plan = split_plan_of(total_df, score_bytes, cfg.max_broadcast_bytes, cfg.task_rows)
    tail_plan = None
    if tail is not None:
        tail = materialize(tail, cfg.keep)
        kept.append(tail)
        row_bytes = string_bytes(F.col("term")) + F.lit(64 + 9 * C.slots_of(cfg.topic_block, n_defined))
        tail_plan = plan_split(tail, "df", row_bytes, cfg.max_broadcast_bytes, cfg.task_rows)
    return CentroidModel(n_docs, factors, sums, vocab, tnorms, n_topics, n_defined, topic_bytes, row["first"], index, table, tail,
                         factor_plan, score_plan, tail_plan, cfg, kept)


def _index(model: CentroidModel) -> DataFrame:
    return C.small(model.index, model.topic_bytes, model.config.max_broadcast_bytes)


@dataclass
class Run:
    """Everything one reference run produces, as relations."""

    prepared: Prepared
    model: CentroidModel
    scored: Scored
    predictions: DataFrame
    edges: DataFrame

    def relevant(self) -> DataFrame:
        return L.relevant_counts(self.edges)

    def evaluation(self, full: bool = False) -> DataFrame:
        return E.evaluation(self.predictions, self.model.vocabulary, self.relevant(), full=full)

    def accuracy(self) -> DataFrame:
        return E.accuracy(self.predictions)

    def report(self, full: bool = False, literal: bool = True) -> DataFrame:
        return E.report_lines(self.evaluation(full), self.accuracy(), literal=literal)

    def ranking(self, k: int | None = None) -> DataFrame:
        return S.rank_topics(self.scored.sims) if k is None else self.scored.top(k)

    def true_topic_margin(self) -> DataFrame:
        test_edges = self.edges.where(F.col("split") == R.TEST)
        return S.true_topic_margin(self.scored.sims, self.predictions, test_edges, _index(self.model))

    def close(self) -> None:
        for part in (self.scored, self.model, self.prepared):
            part.close()
        self.predictions.unpersist()


def classify(model: CentroidModel, prepared: Prepared, shared: bool = False) -> tuple[Scored, DataFrame]:
    """G1-G3 for the classifiable test documents of ``prepared``. ``shared``: the
    caller will read pairs, too, so the sums that both come from are kept first
    (a pruned search has sums of its own)."""
    test = prepared.test_docs()
    scored = model.score(R.test_documents(prepared.doc_terms))
    if shared and model.tail is None:
        scored.blocks()
    return scored, S.assign(test, scored.near(), model.default_topic)


def classify_documents(model: CentroidModel, docs: DataFrame) -> tuple[DataFrame, list]:
    """The nearest topic of every document of ``docs``, labelled or not, of any
    split: ``(doc_id, topic, sim, zero_overlap, correct)`` with ``correct`` NULL
    where there is no label, and a row with topic NULL for a document without
    a known term. Of copies of an id the last in the model's order counts.

    Also returns what was kept for it; call ``unpersist`` on each when done.
    """
    cfg = model.config
    order = [c for c in cfg.order if c in docs.columns] + [CONTENT]
    topics = F.col("topics") if "topics" in docs.columns else F.array().cast("array<string>")
    texts = docs.withColumn(CONTENT, F.xxhash64(*docs.columns)).select(
        "doc_id", *order, F.coalesce("body", F.lit("")).alias("body"), L.clean_topics(topics).alias("topics"))
    counted = materialize(
        T.doc_terms(texts, cfg.profile, cfg.stop_words, keep=("doc_id", "topics", *order),
                    max_token_length=cfg.max_token_length), cfg.keep)
    dterms = R.dedup_last(counted, order=order)
    scored = model.score(dterms)
    preds = S.assign(dterms.select("doc_id", "topics"), scored.near(), model.default_topic)
    return preds, [counted, *scored._kept]


def run_pipeline(corpus: DataFrame, config: Config = Config(), pairs: bool = False) -> Run:
    """The reference's whole job on a document relation; ``pairs``: similarities,
    rankings or margins will be read, too."""
    prepared = prepare(corpus, config)
    model = fit(prepared, config)
    scored, preds = classify(model, prepared, shared=pairs)
    preds = materialize(preds, config.keep)
    return Run(prepared, model, scored, preds, prepared.edges())


__all__ = ["Config", "Prepared", "CentroidModel", "Scored", "Run", "prepare", "fit", "model_of", "classify",
           "classify_documents", "run_pipeline"]
