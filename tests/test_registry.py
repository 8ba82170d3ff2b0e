from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import pytest

from pitf.operators import registry as reg
from pitf.sources.tables import publish, published, typed_rows


def version(n, auc=0.62, lift=1.25, alias=None, model="m", input_hash=None):
    return (model, n, f"p/{n}", None, auc, None, lift, None, alias, input_hash)


def registry(spark, *rows):
    return typed_rows(spark, rows, reg.REGISTRY_SCHEMA)


GATE_CASES = {  # model: newest AUC, newest lift, champion's AUC, reason
    "at_both_bounds": (0.58, 1.10, None, reg.GATE_PASSED),
    "just_under_auc": (0.5799, 4.0, None, "auc_low"),
    "just_under_lift": (0.99, 1.0999, None, "lift_low"),
    "within_the_loss": (0.7001, 2.0, 0.72, reg.GATE_PASSED),
    "beyond_the_loss": (0.6999, 2.0, 0.72, "auc_below_champion"),
    "better_than_champion": (0.81, 1.5, 0.72, reg.GATE_PASSED),
    "all_rules": (0.41, 0.2, 0.93, "auc_low+lift_low+auc_below_champion"),
    "no_auc": (None, 3.0, 0.72, "metric_missing"),
    "no_lift": (0.3, None, None, "metric_missing+auc_low"),
}


def test_gate_decides_every_model_at_once(spark):
    rows = [version(5, auc, lift, model=name) for name, (auc, lift, _, _) in GATE_CASES.items()]
    rows += [version(4, champion, 1.2, reg.CHAMPION, name) for name, (_, _, champion, _) in GATE_CASES.items() if champion]
    got = {r["model_name"]: (r["version"], r["reason"], r["promote"]) for r in reg.evaluate_gate(registry(spark, *rows)).collect()}
    assert got == {name: (5, reason, reason == reg.GATE_PASSED) for name, (*_, reason) in GATE_CASES.items()}


def test_gate_skips_the_champion_check_on_itself(spark):
    verdict = reg.evaluate_gate(registry(spark, version(1, 0.60, 1.2, reg.CHAMPION))).first()
    assert verdict["promote"] and verdict["champion_roc_auc"] is None


def test_empty_registry(spark):
    nothing = registry(spark)
    assert reg.evaluate_gate(nothing).collect() == [] and reg.latest(nothing).collect() == []


def test_alias_is_unique_and_other_models_are_untouched(spark):
    before = registry(spark, version(1, alias=reg.CHAMPION), version(2), version(1, alias=reg.CHAMPION, model="other"),
                      version(3, alias="shadow"))
    target = typed_rows(spark, [("m", 2)], "model_name STRING, version INT")
    after = {(r["model_name"], r["version"]): r["alias"] for r in reg.move_alias(before, target).collect()}
    assert after == {("m", 1): None, ("m", 2): reg.CHAMPION, ("m", 3): "shadow", ("other", 1): reg.CHAMPION}
    again = reg.move_alias(reg.move_alias(before, target), target)
    assert {(r["model_name"], r["version"]): r["alias"] for r in again.collect()} == after


def test_lookups_take_the_newest(spark):
    table = registry(spark, version(1, input_hash="x", alias="a"), version(2, input_hash="x"), version(3, input_hash="y"),
                     version(4, input_hash=""))
    assert reg.latest(table).first()["version"] == 4
    assert reg.by_alias(table, "a").first()["version"] == 1
    assert {r["input_hash"]: r["version"] for r in reg.by_input_hash(table).collect()} == {"x": 2, "y": 3}


def test_append_numbers_after_the_newest(spark):
    table = registry(spark, version(1), version(7))
    added = reg.append(table, registry(spark, version(None), version(None, model="new")))
    assert sorted((r["model_name"], r["version"]) for r in added.collect()) == [("m", 1), ("m", 7), ("m", 8), ("new", 1)]
    assert added.columns == table.columns


def test_two_writers_lose_no_update(spark, tmp_path):
    """Both start from the same states again and again; every version is there once, and no loser's folder is left."""
    stores = [reg.RegistryStore(spark, str(tmp_path / "registry"), keep=4) for _ in range(2)]

    def add_three(i):
        return [stores[i].update(lambda now: reg.append(now, registry(spark, version(None, input_hash=f"{i}-{n}"))))
                for n in range(3)]

    with ThreadPoolExecutor(2) as pool:
        numbers = [n for taken in pool.map(add_three, range(2)) for n in taken]
    rows = stores[0].read().collect()
    assert sorted(numbers) == sorted(r["version"] for r in rows) == [1, 2, 3, 4, 5, 6]
    assert {r["input_hash"] for r in rows} == {f"{i}-{n}" for i in range(2) for n in range(3)}
    assert len(list((tmp_path / "registry").glob("state-*"))) == 4


def test_a_writer_that_lost_the_race_applies_its_change_again(spark, tmp_path):
    store, seen = reg.RegistryStore(spark, str(tmp_path / "registry")), []
    store.write(registry(spark, version(1)))

    def late(now):
        seen.append(now.count())
        if len(seen) == 1:  # another writer commits while this one computes
            reg.RegistryStore(spark, store.path).update(lambda rows: reg.append(rows, registry(spark, version(None, model="other"))))
        return reg.append(now, registry(spark, version(None)))

    assert store.update(late) == 3 and seen == [1, 2]
    assert sorted((r["model_name"], r["version"]) for r in store.read().collect()) == [("m", 1), ("m", 2), ("other", 1)]
    with pytest.raises(reg.CommitConflict):
        store.update(lambda now: reg.RegistryStore(spark, store.path).write(now) and now, attempts=2)


def test_old_states_are_dropped_and_an_unfinished_one_is_not_read(spark, tmp_path):
    folder = tmp_path / "registry"
    store = reg.RegistryStore(spark, str(folder), keep=2)
    assert store.read().count() == 0
    (folder / "state-cut-off").mkdir(parents=True)
    for n in (1, 2, 3, 4):
        store.update(lambda now: now.unionByName(registry(spark, version(n))))
    assert sorted(r["version"] for r in store.read().collect()) == [1, 2, 3, 4]
    assert sorted(p.name for p in (folder / "commits").glob("*.commit")) == ["0000000003.commit", "0000000004.commit"]
    assert len(list(folder.glob("state-*"))) == 3


def test_a_file_is_published_once(spark, tmp_path):
    path = str(tmp_path / "some" / "7.claim")
    assert publish(spark, path, "first") and not publish(spark, path, "second")
    assert published(spark, str(tmp_path / "some"), "claim") == {"7.claim": "first"}
    assert published(spark, str(tmp_path / "nowhere"), "claim") == {}


def test_comparison_prefers_the_first_candidate_on_a_tie(spark):
    metrics = spark.createDataFrame([("m", "lr", 0.6), ("m", "gbt", 0.6), ("one", "lr", 0.7)],
                                    "model_name STRING, model_type STRING, roc_auc DOUBLE")
    got = {r["model_name"]: (r["winner"], r["roc_auc_margin"])
           for r in reg.compare_candidates(metrics, ["gbt", "lr"]).collect()}
    assert got == {"m": ("gbt", 0.0), "one": ("lr", 0.7)}
