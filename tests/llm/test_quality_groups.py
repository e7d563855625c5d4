"""Small groups are judged by an estimate of their own."""

import random

from matchlake.llm import quality_mcd as Q


def written_by(rng, letters, n):
    return " ".join("".join(rng.choice("etaoinshr") for _ in range(rng.choice(letters))) for _ in range(n))


def test_a_small_source_with_a_style_of_its_own_stays(frame):
    """60 documents of very long words, among 400 of short ones in four sources of the same language."""
    rng = random.Random(8)
    rows = [(i, written_by(rng, (3, 4, 5), 80), "en", f"s{i % 4}") for i in range(400)]
    rows += [(1000 + i, written_by(rng, (11, 12, 13), 80), "en", "long") for i in range(60)]
    rows += [(2000, written_by(rng, (3, 4, 5), 80), "en", "long")]
    kept = {r.doc_id: r.kept for r in Q.report(frame(rows)).collect()}
    assert sum(kept[1000 + i] for i in range(60)) == 60
    assert sum(kept[i] for i in range(400)) == 400
