import json

import pytest

ROW = "id string, split string, scope string, source string, group_key string, similarity_text string, input_json string, links array<string>, group_members array<string>, extra int, cid long, key string"
FIELDS = [f.split()[0] for f in ROW.split(", ")]


@pytest.fixture
def rows(spark):
    """Rows from dicts; columns that operators use inside stand among the extra ones."""

    def make(*dicts):
        return spark.createDataFrame([tuple(d.get(f) for f in FIELDS) for d in dicts], ROW)

    return make


def as_input(scene, action, field="player_action", **more):
    return json.dumps({"scene": scene, field: action} | more)


def pairs(df, *columns):
    out = [tuple(r) for r in df.select(*columns).collect()]
    assert len(out) == len(set(out))
    return set(out)
