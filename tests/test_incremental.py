"""Facts brought up to date by what their inputs changed, against facts built anew."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

from dimflow.operators.facts import CurrentRef, FactSpec, VersionedRef, build_fact
from dimflow.operators.pointintime import entity_versions
from dimflow.plans.star import CurrentDim, Star, VersionedDim, build_star
from dimflow.registry import TableSpec
from dimflow.sources import load
from dimflow.sources.store import ANALYTICS, RAW
from tests.conftest import rows

DAY = datetime(2026, 1, 1)
SPECS = [
    TableSpec("people", ("id",), incremental=True),
    TableSpec("shops", ("shop",)),
    TableSpec("sales", ("sale",), incremental=True, id_range=10),
]
FACT = FactSpec(
    "fact", "sales", "sale", "sale_sk", "sold_at", ("sale_sk", "person_key", "shop_key", "date_key", "amount"),
    versioned=(VersionedRef("dim_person", "person_key", "id", "buyer"),),
    current=(CurrentRef("dim_shop", "shop_key", "shop", "at_shop", "shop_key"),), id_range=10,
)
STAR = Star((VersionedDim("dim_person", "people", "person_key", "code", "id", ("town",)),), (CurrentDim("dim_shop", "shops", "shop_key", "shop"),), (FACT,))


class World:
    """Source tables that change by hand."""

    def __init__(self, spark, store):
        self.spark, self.store, self.now = spark, store, DAY
        self.people = {i: (i, f"p{i}", "north", DAY) for i in range(1, 7)}
        self.shops = {i: (i, f"s{i}") for i in (1, 2, 4)}
        self.sales = {i: self.sale(i) for i in range(100)}

    def sale(self, i, days=None, amount=1):
        rnd = random.Random(i)
        sold = DAY + timedelta(days=rnd.randint(-20, 20) if days is None else days)
        return i, rnd.randint(1, 8), rnd.randint(1, 5), sold, amount, self.now

    def source(self, name):
        schema = {
            "people": "id int, code string, town string, updated_at timestamp_ntz", "shops": "shop int, name string",
            "sales": "sale int, buyer int, at_shop int, sold_at timestamp_ntz, amount int, updated_at timestamp_ntz",
        }[name]
        return self.spark.createDataFrame(list(getattr(self, name).values()), schema)

    def run(self):
        """Load and build; the fact as stored is what building it anew gives."""
        load.run(self.store, self.source, SPECS)
        build_star(self.store, STAR, self.now.strftime("%Y-%m-%d %H:%M:%S"))
        dim = self.store.read(ANALYTICS, "dim_person")
        versions = {"dim_person": entity_versions(self.store.read(RAW, "people"), dim, "id", "person_key", "code")}
        anew = build_fact(self.store.read(RAW, "sales"), FACT, versions, {"dim_shop": self.store.read(ANALYTICS, "dim_shop")})
        stored = rows(self.store.read(ANALYTICS, "fact"))
        assert stored == rows(anew) and len(stored) == len(self.sales)
        return {r[0]: r for r in stored}

    def touched(self):
        """The buckets that the newest commit rewrote."""
        commit = self.store.commit(ANALYTICS, "fact")
        return {b for b, g in commit.live.items() if g == commit.generation}


def test_each_kind_of_change_rewrites_the_buckets_it_can_reach(spark, store):
    world = World(spark, store)
    built = world.run()
    assert sum(r[1] is None for r in built.values()) > 10 and sum(r[2] is None for r in built.values()) > 10

    before = store.commit(ANALYTICS, "fact")
    world.run()  # nothing changed, but lookups are replaced each time: nothing is rewritten
    assert store.commit(ANALYTICS, "fact").live == before.live

    world.now = DAY + timedelta(days=10)
    world.sales[3] = world.sale(3, amount=7)  # one bucket, one replaced and one new row
    world.sales[205] = world.sale(205)
    after = world.run()
    assert world.touched() == {0, 20} and after[3][4] == 7

    world.now = DAY + timedelta(days=15)
    world.people[2] = (2, "p2", "south", world.now)  # a change: facts of its buyer from that day on
    after = world.run()
    reached = {i for i, s in world.sales.items() if s[1] == 2 and s[3] >= world.now}
    assert reached and world.touched() == {i // 10 for i in reached}
    assert {after[i][1] for i in reached} == {7}

    world.now = DAY + timedelta(days=16)
    world.people[7] = (7, "p7", "north", world.now)  # a new key: facts that found nobody
    after = world.run()
    reached = {i for i, s in world.sales.items() if s[1] == 7}
    assert world.touched() == {i // 10 for i in reached} and all(after[i][1] == 8 for i in reached)

    world.shops[3] = (3, "s3")  # a lookup row comes, another goes; the others keep their keys
    del world.shops[1]
    keys = {r[1]: r[0] for r in rows(store.read(ANALYTICS, "dim_shop"))}
    after = world.run()
    assert {r[1]: r[0] for r in rows(store.read(ANALYTICS, "dim_shop"))} == {2: keys[2], 4: keys[4], 3: 4}
    reached = {i for i, s in world.sales.items() if s[2] in (1, 3)}
    assert world.touched() == {i // 10 for i in reached}
    assert all(after[i][2] == (4 if world.sales[i][2] == 3 else None) for i in reached)

    world.now = DAY + timedelta(days=17)
    world.people[5] = (5, "p6", "north", world.now)  # an entity under another's natural key
    del world.people[6]
    world.people[6] = (6, "p9", "north", world.now)
    after = world.run()
    reached = {i for i, s in world.sales.items() if s[1] in (5, 6)}
    assert {i // 10 for i in reached} == world.touched()

    for i in (3, 50):  # rows that went at the source, found by a repair
        del world.sales[i]
    assert load.repair(store, world.source, SPECS[2]).extra == 2
    after = world.run()
    assert 3 not in after and world.touched() == {0, 5}


def test_a_fact_is_built_anew_where_an_input_kept_no_record(spark, store):
    world = World(spark, store)
    world.run()
    store.replace(RAW, "other", spark.range(1))
    replaced = [SPECS[0], SPECS[1], TableSpec("sales", ("sale",))]
    store2 = type(store)(spark, store.root + "2")
    for amount in (1, 2):
        world.sales[3] = world.sale(3, amount=amount)
        load.run(store2, world.source, replaced)
        build_star(store2, STAR, "2026-03-01 00:00:00")
    assert rows(store2.read(ANALYTICS, "fact").where("sale_sk = 3").select("amount")) == [(2,)]
    commit = store2.commit(ANALYTICS, "fact")
    assert set(commit.live.values()) == {1}
