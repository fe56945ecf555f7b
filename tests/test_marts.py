"""Marts on hand-made titles that carry every null, empty and tie case."""

from __future__ import annotations

import datetime as dt
import json
import random
from collections import defaultdict
from itertools import product
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from titlemart.functions.scalars import IMAGE_PREFIX
from titlemart.operators import reconcile
from titlemart.plans import build_marts, load_and_build, marts
from titlemart.quality import CheckFailed, check_unique
from titlemart.schema import TITLES_DDL, titles_schema
from titlemart.session import shared_dir
from titlemart.sinks import read_table
from titlemart.sources import list_files


def title(id, **given):
    row = dict.fromkeys(line.split()[0] for line in TITLES_DDL.strip().splitlines())
    row.update(
        id=id, title=f"T{id}", status="Released", popularity=1.0, vote_average=1.0, vote_count=3,
        release_date=dt.date(2016, 1, 2), revenue=10, budget=5, video=False,
        genres=[], production_companies=[], production_countries=[], spoken_languages=[],
        belongs_to_collection=[],
    )
    row.update(given)
    return row


def genre(id, name):
    return {"id": id, "name": name}


def company(id, name, country="X"):
    return {"id": id, "logo_path": None, "name": name, "origin_country": country}


def country(code, name):
    return {"iso_3166_1": code, "name": name}


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[n] for n in titles_schema().names) for r in rows], titles_schema())


ROWS = [
    title(1, genres=None, vote_average=9.0),
    title(2, genres=[], vote_average=9.5, release_date=dt.date(2018, 12, 31)),
    title(
        3, genres=[genre(7, "drama")], vote_average=8.0, popularity=4.0,
        production_countries=[country("A", "Aland")], production_companies=[],
    ),
    title(
        4, genres=[genre(7, "drama"), genre(None, "odd")], vote_average=8.0, popularity=None,
        production_countries=[country("B", "Bland"), country("C", None)],
        production_companies=[company(1, "one"), company(2, None)],
    ),
    title(5, genres=[genre(None, "lost")], vote_average=None),
    title(6, genres=[genre(None, "lost")], vote_average=None),
    title(7, genres=[genre(8, None)], vote_average=2.0, release_date=None),
    title(8, status="Rumored", vote_average=99.0),
    title(9, status=None, vote_average=98.0),
    title(10, release_date=dt.date(2018, 12, 31), vote_average=9.5, poster_path="/p.jpg"),
]


def reference_best(rows, key_of, value):
    groups = defaultdict(list)
    for row in rows:
        for key in key_of(row):
            groups[key].append(row)
    rank = lambda r: (r[value] is not None, r[value] or 0, r["id"])
    return {k: max(g, key=rank) for k, g in groups.items()}


def reference_lists(rows, id, arrays):
    """Distinct values per array over the product of a title's arrays."""
    found = [set() for _ in arrays]
    for row in rows:
        if row["id"] == id:
            for combination in product(*[row[a] or [] for a in arrays]):
                for values, entry in zip(found, combination):
                    values.add(entry["name"])
    if not found[0]:
        return [None] * len(arrays)
    return [sorted(v, key=lambda n: (n is not None, n or "")) for v in found]


def genre_names(row):
    return [g["name"] for g in row["genres"] or []]


def iso_years(row):
    day = row["release_date"]
    return [day.isocalendar()[0]] if row["status"] == "Released" and day else []


def random_titles(seed, n=300):
    rng = random.Random(seed)
    pick = lambda make, k: [make(rng.randrange(6)) for _ in range(rng.randrange(k))]
    name = lambda i: None if i == 0 else f"n{i}"
    return [
        title(
            i,
            vote_average=rng.choice([None, 1.0, 2.0, 3.0]),
            popularity=rng.choice([None, 1.5, 2.5, 9.5]),
            release_date=dt.date(2010 + rng.randrange(4), rng.choice([1, 12]), rng.choice([1, 2, 30, 31])),
            status=rng.choice(["Released", "Released", "Rumored", None]),
            revenue=rng.choice([None, rng.randrange(1000)]),
            genres=rng.choice([None, pick(lambda g: genre(g or None, name(g)), 4)]),
            production_companies=pick(lambda c: company(c, name(c)), 4),
            production_countries=pick(lambda c: country(str(c), name(c)), 3),
            belongs_to_collection=pick(
                lambda c: {"id": c, "name": name(c), "poster_path": None, "backdrop_path": f"/{c}"}, 3
            ),
        )
        for i in range(n)
    ]


@pytest.fixture(scope="module", params=["hand", 1, 2])
def rows(request):
    return ROWS if request.param == "hand" else random_titles(request.param)


@pytest.fixture(scope="module")
def titles(spark, rows):
    return frame(spark, rows).persist()


@pytest.mark.parametrize(
    "mart, value, out",
    [(marts.fav_by_genre, "vote_average", "movie_vote_avg"),
     (marts.popular_by_genre, "popularity", "movie_popularity")],
)
def test_best_of_genre(titles, rows, mart, value, out):
    want = reference_best(rows, genre_names, value)
    got = {r.genres: r for r in mart(titles).collect()}
    assert got.keys() == want.keys()
    for name, row in want.items():
        countries = reference_lists(rows, row["id"], ["production_countries", "production_companies"])[0]
        assert (got[name].movie_id, got[name][out], got[name].movie_title) == (row["id"], row[value], row["title"])
        assert got[name].movie_country == (countries[0] if countries else None)
        assert got[name].year == (row["release_date"].isocalendar()[0] if row["release_date"] else None)


@pytest.mark.parametrize(
    "mart, value, out",
    [(marts.fav_per_year, "vote_average", "movie_vote_avg"),
     (marts.popular_per_year, "popularity", "movie_popularity")],
)
def test_best_of_year(titles, rows, mart, value, out):
    want = reference_best(rows, iso_years, value)
    result = mart(titles).collect()
    assert [r.year for r in result] == sorted(want, reverse=True)
    for r in result:
        row = want[r.year]
        lists = reference_lists(rows, row["id"], ["production_countries", "genres", "production_companies"])
        assert (r.movie_id, r[out], r.revenue, r.release_date) == (
            row["id"], row[value], row["revenue"], row["release_date"])
        assert [r.movie_country, r.genre_name, r.ph_name] == lists


@pytest.mark.parametrize(
    "mart, array, fields, key",
    [(marts.genres, "genres", ("id", "name"), "id"),
     (marts.production_countries, "production_countries", ("name", "iso_3166_1"), "iso_3166_1"),
     (marts.spoken_languages, "spoken_languages", ("name", "iso_639_1"), "iso_639_1")],
)
def test_dimensions(titles, rows, mart, array, fields, key):
    want = {
        tuple(e[f] for f in fields)
        for r in rows
        if any(e[key] is not None for e in r[array] or [])
        for e in r[array]
    }
    got = [tuple(r) for r in mart(titles).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    keys = [g[fields.index(key)] for g in got]
    assert keys == sorted(keys, key=lambda k: (k is not None, k if k is not None else 0))


def test_collections(titles, rows):
    want = defaultdict(set)
    for r in rows:
        for c in r["belongs_to_collection"] or []:
            want[(c["id"], c["name"])].add((r["id"], r["title"]))
    got = {
        (r.collection_id, r.collection_name): list(zip(r.movie_id, r.movie_title))
        for r in marts.collection_lists(titles).collect()
    }
    assert got == {k: sorted(v) for k, v in want.items()}


def test_portfolio(titles, rows):
    want = defaultdict(list)
    for r in rows:
        for c, g in product(r["production_companies"] or [], r["genres"] or []):
            want[(c["id"], c["name"], c["origin_country"])].append((r, g["name"]))
    result = marts.company_portfolio(titles).collect()
    assert {(r.ph_id, r.ph_name, r.ph_country) for r in result} == want.keys()
    none_first = lambda v: (v is not None, v or "")
    for r in result:
        pairs = want[(r.ph_id, r.ph_name, r.ph_country)]
        scores = [t["popularity"] for t, _ in pairs if t["popularity"] is not None]
        revenue = [t["revenue"] for t, _ in pairs if t["revenue"] is not None]
        assert [m.genres for m in r.ph_movie] == sorted((g for _, g in pairs), key=none_first)
        assert r.ph_total_movie == len(pairs)
        assert r.ph_total_revenue == (sum(revenue) if revenue else None)
        assert r.average_popularity_movie_score == (
            pytest.approx(sum(scores) / len(scores)) if scores else None)
    counted = {r.ph_id: r for r in marts.company_portfolio(titles, "counts").collect()}
    for r in result:
        assert sum(m.n for m in counted[r.ph_id].ph_movie) == len(r.ph_movie)


def test_a_large_collection_and_company_are_one_row(spark):
    """600,000 titles of one collection and one company: one row each, and totals counted once."""
    from titlemart.schema import TITLES_DDL, titles_schema

    n = 600_000
    shape = {f.name: f.dataType for f in titles_schema().fields}
    given = {
        "id": F.col("id"), "title": F.lit("t"), "popularity": F.lit(1.0), "revenue": F.lit(2), "budget": F.lit(3),
        "belongs_to_collection": F.array(F.struct(F.lit(5).alias("id"), F.lit("c").alias("name"), F.lit("/p").alias("poster_path"), F.lit("/b").alias("backdrop_path"))),
        "genres": F.array(F.struct(F.lit(1).alias("id"), F.lit("g").alias("name"))),
        "production_companies": F.array(F.struct(F.lit(7).alias("id"), F.lit("l").alias("logo_path"), F.lit("co").alias("name"), F.lit("x").alias("origin_country"))),
    }
    titles = spark.range(n).select(*[given.get(c, F.lit(None)).cast(t).alias(c) for c, t in shape.items()])
    lists = marts.collection_lists(titles).select("collection_id", F.size("movie_id").alias("n"))
    check_unique(lists, "collection_id")
    assert lists.first().n == n and marts.collection_lists(titles, "rows").count() == n
    portfolio = marts.company_portfolio(titles).select(F.size("ph_movie").alias("n"), "ph_total_movie").collect()
    assert [tuple(r) for r in portfolio] == [(n, n)]
    assert [r.ph_total_movie for r in marts.company_portfolio(titles, "rows").collect()] == [n]


def test_media(titles, rows):
    got = marts.media(titles).collect()
    assert [r.movie_id for r in got] == sorted(r["id"] for r in rows)
    for r, row in zip(got, sorted(rows, key=lambda r: r["id"])):
        path = row["poster_path"]
        assert r.poster_image_url == (IMAGE_PREFIX + path if path else None)


def test_one_id_with_two_titles_fans_out(spark):
    rows = [
        title(1, genres=[genre(1, "g")], production_countries=[country("A", "a")],
              production_companies=[company(1, "c")]),
        title(1, title="other", production_countries=[country("B", "b")],
              production_companies=[company(2, "d")], genres=[genre(2, "h")],
              belongs_to_collection=[{"id": 5, "name": "k", "poster_path": None, "backdrop_path": None}]),
    ]
    titles = frame(spark, rows)
    assert sorted((r.genres, r.movie_title) for r in marts.fav_by_genre(titles).collect()) == [
        ("g", "T1"), ("g", "other"), ("h", "T1"), ("h", "other")]
    per_year = marts.fav_per_year(titles).collect()
    assert sorted(r.movie_title for r in per_year) == ["T1", "other"]
    assert all(r.movie_country == ["a", "b"] and r.ph_name == ["c", "d"] for r in per_year)
    assert [r.movie_title for r in marts.collection_lists(titles).collect()] == [["T1", "other"]]


def test_null_id_keeps_its_row_without_attributes(spark):
    titles = frame(spark, [title(None, title="x", genres=[genre(1, "g")], vote_average=5.0)])
    (row,) = marts.fav_by_genre(titles).collect()
    assert (row.genres, row.movie_id, row.movie_vote_avg, row.movie_title) == ("g", None, 5.0, None)


def test_same_collection_with_two_posters_gives_two_rows(spark):
    c = {"id": 5, "name": "k", "poster_path": "/a", "backdrop_path": None}
    titles = frame(spark, [title(1, belongs_to_collection=[c]),
                           title(2, belongs_to_collection=[{**c, "poster_path": "/b"}])])
    assert len(marts.collection_lists(titles).collect()) == 2


def scratch(spark):
    folder = Path(shared_dir(spark).removeprefix("file:"))
    return set(folder.iterdir()) if folder.exists() else set()


def test_build_all(spark, tmp_path):
    titles = frame(spark, random_titles(3, 40))
    before = scratch(spark)
    built = {b.name: b for b in build_marts(spark, titles, str(tmp_path))}
    assert scratch(spark) == before
    with pytest.raises(CheckFailed, match="movies_spoken_language"):
        build_marts(spark, titles, str(tmp_path), ["movies_media", "movies_spoken_language"], raise_on_failure=True)
    assert len(built) == 10 and built["movies_media"].passed
    assert not built["movies_spoken_language"].passed  # no languages in these titles
    assert read_table(spark, built["movies_media"].path).count() == 40
    again = build_marts(spark, titles, str(tmp_path), ["movies_media"])
    assert again[0].passed and read_table(spark, again[0].path).count() == 40


def test_files_to_marts(spark, tmp_path):
    files = tmp_path / "files"
    files.mkdir()
    for row in random_titles(4, 30):
        (files / f"{row['id']}.json").write_text(json.dumps(row, default=str))
    (tmp_path / "copy").mkdir()
    (tmp_path / "copy" / "0.json").write_text("{}")
    offered, copied = (list_files(spark, f"{tmp_path}/{f}/*") for f in ("files", "copy"))
    assert offered.count() == 30 and reconcile(offered, copied, "name").count() == 29

    root = str(tmp_path / "root")
    with pytest.raises(CheckFailed, match="movies_spoken_language"):  # no languages in these titles
        load_and_build(spark, f"{files}/*.json", root, n_files=20, seed="x")
    assert read_table(spark, f"{root}/raw_movies").count() == 20
    with pytest.raises(ValueError, match="population of 30"):
        load_and_build(spark, f"{files}/*.json", root, n_files=31)
    with pytest.raises(CheckFailed, match="movies_spoken_language"):
        load_and_build(spark, f"{files}/*.json", root)
    staged = read_table(spark, f"{root}/raw_movies")
    whole = frame(spark, random_titles(4, 30))
    assert staged.select("id", "genres.name", "release_date", "popularity").exceptAll(
        whole.select("id", "genres.name", "release_date", "popularity")).isEmpty()


@pytest.mark.parametrize("seed", [None, 1, 2])
def test_best_of_together(spark, seed):
    """The four marts out of two scans have the rows, columns and order of those built alone."""
    rows = ROWS if seed is None else random_titles(seed)
    titles = frame(spark, rows + [dict(r, title="again", production_countries=[country("Z", "Z")]) for r in rows[2:9]])
    alone = {
        "movies_most_fav_by_genre": marts.fav_by_genre, "movies_popular_movie_by_genre": marts.popular_by_genre,
        "movies_most_fav_per_year": marts.fav_per_year, "movies_popular_released_per_year": marts.popular_per_year,
    }
    together = marts.best_of(titles)
    assert together.keys() == alone.keys()
    for name, build in alone.items():
        want, got = build(titles), together[name]
        assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in want.schema]
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), name
    assert all(not f.collect() for f in marts.best_of(titles.where("false")).values())


def test_best_of_scans_twice(spark, tmp_path):
    frame(spark, random_titles(3)).write.parquet(f"{tmp_path}/titles")
    titles = spark.read.parquet(f"{tmp_path}/titles")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    best = marts.winners(titles)
    narrow = plan(best)
    assert narrow.count("FileScan") == 1 and "overview" not in narrow and "Window" not in narrow
    assert plan(marts.winner_details(titles, spark.createDataFrame(best.collect(), best.schema))).count("FileScan") == 1
    assert not any("titles" in plan(mart) for mart in marts.best_of(titles).values())


@pytest.mark.parametrize("at_once", [1, 3])
def test_best_of_marts_with_few_threads(spark, tmp_path, at_once):
    titles = frame(spark, random_titles(4))
    names = [*marts.BEST_OF, "movies_genres"]
    titles.dropDuplicates(["id"]).write.parquet(f"{tmp_path}/titles")
    built = build_marts(spark, spark.read.parquet(f"{tmp_path}/titles"), f"{tmp_path}/m", names, at_once)
    assert [b.name for b in built] == names and all(b.passed for b in built if b.name in marts.BEST_OF)
