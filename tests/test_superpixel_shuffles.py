import random

from arpent.operators import segments as sg


def test_pixels_meet_their_nine_centres_without_a_shuffle_by_pixel(spark, monkeypatch):
    rng, plans, kept = random.Random(3), [], sg.stored
    rows = [(r * 23 + c, r, c, float(rng.randint(0, 9))) for r in range(17) for c in range(23)]
    px = spark.createDataFrame(rows, "pid long, r long, c long, v double")
    monkeypatch.setattr(sg, "stored", lambda df: (plans.append(df._jdf.queryExecution().executedPlan().toString()), kept(df))[1])
    got = {x.pid: x.superpixel for x in sg.superpixels(px, ["v"], 5, 3.0, 3).collect()}
    assert len(plans) == 4 and not any("hashpartitioning(pid" in p for p in plans)

    mean = lambda xs: tuple(sum(x[k] for x in xs) / len(xs) for k in (1, 2, 3))
    group = {}
    for x in rows:
        group.setdefault((x[2] // 5, x[1] // 5), []).append(x)
    for _ in range(3):
        centres, group = {k: mean(v) for k, v in group.items()}, {}
        for x in rows:
            near = [(k, centres[k]) for k in ((x[2] // 5 + i, x[1] // 5 + j) for i in (-1, 0, 1) for j in (-1, 0, 1)) if k in centres]
            d = lambda m: (x[3] - m[2]) ** 2 + 0.36 * ((x[1] - m[0]) ** 2 + (x[2] - m[1]) ** 2)  # noqa: B023, E731
            group.setdefault(min(near, key=lambda y: (round(d(y[1]), 9), y[0][1], y[0][0]))[0], []).append(x)
    assert got == {x[0]: min(v)[0] for v in group.values() for x in v}
