"""Releases: readers see whole sets only, whatever happens in between."""

import pytest

from forumlake.plans import facts, marts, pipeline
from forumlake.schemas import SILVER
from forumlake.sources import releases
from test_models import ITEMS

NAMES = ["a", "b", "c"]


def build(spark, root, release, names=NAMES):
    return {n: releases.write_table(spark.range(release).selectExpr("id", f"'{n}' AS of"), root, release, n) for n in names}


def seen(spark, root):
    return {n: (df.count(), {r["of"] for r in df.collect()}) for n, df in releases.read(spark, root).items()}


def test_readers_see_whole_releases(spark, tmp_path):
    root = str(tmp_path / "r")
    assert releases.current(spark, root) is None and releases.unneeded(spark, root) == []
    with pytest.raises(ValueError, match="no complete release"):
        releases.read(spark, root)
    releases.complete(spark, root, 1, build(spark, root, 1))
    releases.move_to(spark, root, 1)
    old = {n: (1, {n}) for n in NAMES}
    for k in range(len(NAMES) + 1):  # a build that dies before its first, between any two, after its last table
        build(spark, root, 2, NAMES[:k])
        assert seen(spark, root) == old
        with pytest.raises(ValueError, match="not complete"):
            releases.move_to(spark, root, 2)
    bound = releases.read(spark, root)
    releases.complete(spark, root, 2, build(spark, root, 2))
    assert seen(spark, root) == old
    releases.move_to(spark, root, 2)
    assert seen(spark, root) == {n: (2, {n}) for n in NAMES}
    assert {n: df.count() for n, df in bound.items()} == {n: 1 for n in NAMES}
    with pytest.raises(ValueError, match="is complete"):
        build(spark, root, 2)
    releases.move_to(spark, root, 2)
    releases.move_to(spark, root, 1)
    assert seen(spark, root) == old
    releases.complete(spark, root, 3, build(spark, root, 3))
    releases.move_to(spark, root, 3)
    assert releases.current(spark, root) == 3 and releases.unneeded(spark, root) == [2]


def test_models_are_published_together(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "r")
    items = spark.createDataFrame(ITEMS, SILVER)
    pipeline.publish_models(items.filter("item_id <= 1"), root, 1)
    before = releases.read(spark, root)["stg_items"].count()

    def broken(_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(marts, "daily_active_authors", broken)
        with pytest.raises(RuntimeError):
            pipeline.publish_models(items, root, 2)
    assert releases.current(spark, root) == 1 and releases.read(spark, root)["stg_items"].count() == before
    models = pipeline.publish_models(items, root, 2, checked=True)
    assert len(models) == 8 and models["stg_items"].count() > before
    assert sorted(map(str, models["story_analytics"].collect())) == sorted(
        map(str, pipeline.build_models(items, "r_silver", "r_gold")["story_analytics"].collect())
    )
    # Doubtful models are not published if they are to be checked.
    with monkeypatch.context() as patch:
        patch.setattr(pipeline, "check_models", lambda m: spark.createDataFrame([("m", "c", "unique")], "model string, column string, check string"))
        with pytest.raises(ValueError, match="m.c.unique"):
            pipeline.publish_models(items, root, 3, checked=True)
    assert releases.current(spark, root) == 2


def test_view_looks_up_stories_only_and_tables_are_packed(spark, tmp_path, monkeypatch):
    root, kinds = str(tmp_path / "releases"), []

    def seen(stories, items, users, made=facts.story_analytics):
        kinds.extend(r.item_type for r in items.select("item_type").distinct().collect())
        return made(stories, items, users)

    monkeypatch.setattr(facts, "story_analytics", seen)
    models = pipeline.publish_models(spark.createDataFrame(ITEMS, SILVER), root, 1)
    assert kinds == ["story"] and models["dim_items"].filter("item_type <> 'story'").count() > 0
    assert models["story_analytics"].filter("item_id IS NULL").count() == 0
    assert models["story_analytics"].count() == models["fct_stories"].count() > 0
    assert all(f.endswith(".zstd.parquet") for f in models["dim_items"].inputFiles())
