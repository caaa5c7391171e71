"""Compaction opens the source's files once for their manifests."""

from __future__ import annotations

from tidemark.plans import files
from tidemark.session import release

SMALL = "/root/testdata/sf0.001"


def test_manifests_are_a_table(spark, monkeypatch):
    seen = {}
    own = files.catalog.compact_bins

    def noted(session, source, bins, destination):
        seen["bins"], seen["source"] = bins.inputFiles(), source.inputFiles()
        return own(session, source, bins, destination)

    monkeypatch.setattr(files.catalog, "compact_bins", noted)
    made = files.compaction_equivalence(spark, SMALL).collect()
    assert seen["bins"] and all("/manifests-" in f for f in seen["bins"])
    assert len(seen["source"]) == 8 and {r.files for r in made} == {1}
    release(spark)
