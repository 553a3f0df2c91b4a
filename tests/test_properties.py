"""Several days of random loads against a plain model of the rules."""

import datetime as dt
import random

import pytest
from conftest import DAY

from strataload.operators import scd2
from strataload.operators.keys import business_rows
from strataload.operators.rows import empty_frame
from strataload.session import materialize
from strataload.sources.schemas import ENTITY_SCHEMAS

HIGH = dt.date(9999, 12, 31)
SCHEMA = ENTITY_SCHEMAS["bl_3nf.ce_customers_scd"]


def clean(text):
    return (text or "").strip(" ") or "N/A"


def random_rows(rng, n):
    keys = ["A", " A", "B", "C ", "D", "", None, "  "]
    names = ["Ann", "ann", " Ann ", None, ""]
    segments = ["Home", "Office", None, " "]
    return [(rng.choice(keys), rng.choice(names), rng.choice(segments)) for _ in range(n)]


class Model:
    """Versions as [id, key, name, segment, start, end, flag]."""

    def __init__(self):
        self.versions = []

    def load(self, cash, card, day):
        best = {}
        for priority, rows in ((1, cash), (2, card)):
            for key, name, segment in rows:
                if (key or "").strip(" "):
                    candidate = (priority, clean(name), clean(segment))
                    key = key.strip(" ")
                    best[key] = min(best.get(key, candidate), candidate)
        top = max([v[0] for v in self.versions], default=0)
        affected = 0
        for key in sorted(best):
            _, name, segment = best[key]
            active = [v for v in self.versions if v[1] == key and v[6] == "Y"]
            if active and (active[0][2], active[0][3]) == (name, segment):
                continue
            if active:
                active[0][5], active[0][6] = day - dt.timedelta(days=1), "N"
                affected += 1
            top += 1
            affected += 1
            self.versions.append([top, key, name, segment, day, HIGH, "Y"])
        return affected


@pytest.mark.parametrize("seed", [1, 2])
def test_history_equals_the_model_and_keeps_its_invariants(spark, sales, seed):
    rng, model = random.Random(seed), Model()
    stored = empty_frame(spark, SCHEMA)
    for offset in range(3):
        day = DAY + dt.timedelta(days=offset)
        cash, card = random_rows(rng, 6), random_rows(rng, 6)
        frames = [
            sales(source, *[{"customer_id": k, "customer_name": n, "segment": s} for k, n, s in rows])
            for source, rows in (("cash", cash), ("card", card))
        ]
        changes = scd2.detect_changes(*frames, stored)
        affected = 2 * changes.where("change_type = 'CHANGED'").count() + changes.where("change_type = 'NEW'").count()
        assert affected == model.load(cash, card, day)
        stored = materialize(scd2.apply_changes(stored, changes, day))
        assert scd2.detect_changes(*frames, stored).count() == 0
    columns = ["customer_id", "customer_src_id", "customer_name", "customer_segment", "start_dt", "end_dt", "is_active"]
    versions = sorted(list(r) for r in business_rows(stored, "customer_id").select(*columns).collect())
    assert versions == sorted(model.versions)
    assert [v[0] for v in versions] == list(range(1, len(versions) + 1))
    by_key = {}
    for version in versions:
        by_key.setdefault(version[1], []).append(version)
    for history in by_key.values():
        assert sum(v[6] == "Y" for v in history) == 1
        for earlier, later in zip(history, history[1:]):
            assert earlier[5] == later[4] - dt.timedelta(days=1)
