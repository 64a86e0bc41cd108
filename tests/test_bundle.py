import pytest

from ticketloom.plans import bundle
from ticketloom.registry import training as registered
from ticketloom.registry.cleaning import agents, tickets_table
from ticketloom.session import scratch_path


@pytest.fixture(scope="module")
def saved(spark, sf):
    omv, origine = registered.gate_models(spark, sf, 8)
    path = scratch_path(spark, "releases")
    return path, omv, [
        bundle.save_bundle(spark, path, agents(spark, sf), omv.classifier, origine.classifier, {"min_samples": n}) for n in (8, 9)]


def test_newest_version_comes_back_as_saved(spark, sf, saved):
    path, omv, versions = saved
    assert set(bundle.versions(spark, path)) == set(versions)
    loaded = bundle.load_bundle(spark, path, versions[1])
    assert loaded.config == {"min_samples": 9}
    assert bundle.load_bundle(spark, path).version in versions
    assert sorted(loaded.agents.collect()) == sorted(agents(spark, sf).select("agent", "service").collect())
    tickets = tickets_table(spark, sf).limit(50)
    want = {r.incident_id: r.probabilities for r in omv.classifier.probabilities(tickets).collect()}
    got = {r.incident_id: r.probabilities for r in loaded.omv.probabilities(tickets).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_loaded_once(spark, saved):
    path, _, versions = saved
    assert bundle.load_bundle(spark, path, versions[0]) is bundle.load_bundle(spark, path, versions[0])


def test_a_half_written_version_is_never_loaded(spark, sf, saved, monkeypatch):
    omv, origine = registered.gate_models(spark, sf, 8)
    path = scratch_path(spark, "broken")
    monkeypatch.setattr(origine.classifier, "save", lambda *_: 1 / 0, raising=False)
    with pytest.raises(ZeroDivisionError):
        bundle.save_bundle(spark, path, agents(spark, sf), omv.classifier, origine.classifier, {})
    assert bundle.versions(spark, path) == []
    with pytest.raises(FileNotFoundError):
        bundle.load_bundle(spark, path)


def test_a_changed_version_is_refused(spark, sf, saved):
    path, omv, versions = saved
    other = bundle.save_bundle(spark, path, agents(spark, sf), omv.classifier, omv.classifier, {})
    agents(spark, sf).limit(1).select("agent", "service").write.mode("append").parquet(f"{path}/versions/{other}/agents")
    with pytest.raises(ValueError, match="agents"):
        bundle.load_bundle(spark, path, other)
