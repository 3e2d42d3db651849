"""The run registry: append-only steps, found again, champion by an aggregate."""

from paysight.operators.registry import Registry, params_of


def _m(rmse):
    return {s: {"MAE": rmse / 2, "RMSE": rmse + (s == "test"), "R2": 0.5, "MAPE": 10.0} for s in ("val", "test")}


def test_steps_are_done_once_and_the_champion_is_strictly_better(spark, tmp_path):
    reg, ran = Registry(spark, str(tmp_path / "registry")), []

    def step(name, rmse, parent=None, **params):
        return reg.step(name, params, lambda folder: ran.append(folder) or (name.upper(), _m(rmse), {"result": rmse}), parent)
    assert reg.table().count() == 0 and reg.champion() is None
    a = step("train", 10.0, depth=6)
    b = step("stack", 10.0, a.key, trees=3)
    assert (a.model, params_of(a), b.parent) == ("TRAIN", {"depth": 6, "result": 10.0}, a.key)
    assert reg.champion().step == "train"  # equal is not better
    assert step("train", 99.0, depth=6) == a and len(ran) == 2  # a repeated step changes nothing
    c = step("stack", 9.0, a.key, trees=4)
    assert reg.champion().key == c.key and reg.champion(["train"]).key == a.key
    assert reg.table().count() == 3 and ran[2].endswith(c.key)
    other = Registry(spark, reg.path)
    assert other.find(b.key) == b and other.champion().metrics["test"]["RMSE"] == 10.0
    assert sorted(tuple(r) for r in other.metrics().select("step", "split", "RMSE").collect())[:2] == [("stack", "test", 10.0), ("stack", "test", 11.0)]
