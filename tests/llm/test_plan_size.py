"""What an operator's plan holds, which the driver keeps in several copies for each run."""

from stratacloud.llm import imatch

from . import common as T


def test_imatch_plan_holds_no_lexicon(spark):
    docs = T.table(spark, [(k, " ".join(f"w{(7 * k + j) % 2000}" for j in range(100)), None, None, 1) for k in range(400)])
    band = (0.1, 9.0)
    assert imatch.Lexicon(imatch.lexicon(docs, band)).n > 1000
    assert len(imatch.fingerprint_edits(docs, band)._jdf.queryExecution().toString()) < 300_000
    assert imatch.fingerprint_edits(docs, band).count() == 400


def test_workers_give_their_memory_back():
    import numpy as np
    import psutil

    from stratacloud.llm.common import released

    def run(batches):
        kept = []
        for n in batches:
            # small pieces, of which the last keeps the others' pages
            kept += [np.zeros(1000) for _ in range(n)]
            last = np.ones(100)
        yield len(kept)
        del kept
        held.append(last)

    held: list = []
    before = psutil.Process().memory_info().rss
    assert list(released(run)(iter([10_000] * 2))) == [20_000]
    assert psutil.Process().memory_info().rss - before < 40e6
