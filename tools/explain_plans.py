"""Print the physical plans of the pipeline's main stages.

    python tools/explain_plans.py [/root/testdata/sf0.01] [formatted|simple]

Stages: the scan + tokenisation (doc_terms), the scoring term table, the
weighted test postings (skew-safe term join), similarities and
predictions. Look for: PushedFilters / ReadSchema on the scan, one
Exchange per aggregation (with a partial HashAggregate before it), and
BroadcastHashJoin only on tables whose size was measured.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    mode = argv[2] if len(argv) > 2 else "formatted"
    from protoclass.operators import routing as R
    from protoclass.operators import terms as T
    from protoclass.plans.pipeline import Config, classify, fit, prepare
    from protoclass.session import local_session
    from protoclass.sources.tables import corpus_view

    spark = local_session()
    prepared = prepare(corpus_view(spark, sf_dir), Config())
    model = fit(prepared)
    scored, preds = classify(model, prepared)
    stages = {
        "doc_terms (scan, route, tokenise, count in-row)":
            T.doc_terms(R.drop_empty_bodies(R.route_splits(corpus_view(spark, sf_dir)))),
        "term statistics": T.term_stats(prepared.doc_terms),
        "scoring term table": model.table,
        "sums by block": scored.blocks(),
        "similarities": scored.sims,
        "three nearest topics": scored.top(3),
        "predictions": preds,
    }
    print(f"split plans: factors {model.factor_plan}, score table {model.score_plan}")
    for name, df in stages.items():
        print("=" * 100)
        print(name)
        print("=" * 100)
        df.explain(mode)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
