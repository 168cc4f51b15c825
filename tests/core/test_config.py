import json
import logging

import pytest

from lakeloom import config, runlog
from lakeloom.operators.rules import REPAIRABLE

SPEC = {
    "names": {"Sub-Category": "sub_category"},
    "ignored": ["row_id"],
    "entities": [{"name": "products", "keys": ["product_id"], "columns": ["product_id", "category"], "allowed": {"category": ["Furniture"]}, "severity": {"category": REPAIRABLE}, "conform": {"category": {"OFF": "Furniture"}}}],
    "dimensions": [{"name": "products", "keys": ["product_id"], "attributes": ["category"], "cluster_by": ["product_id"]}],
    "facts": [{"name": "sales", "keys": ["order_id"], "columns": ["order_id", "sales"]}],
}


def test_config_from_json_and_yaml(tmp_path):
    path = tmp_path / "c.json"
    path.write_text(json.dumps(SPEC))
    c = config.load(str(path))
    assert c.entities["products"].keys == ("product_id",) and c.dimensions["products"].cluster_by == ("product_id",) and c.facts["sales"].columns == ("order_id", "sales")
    assert c.declared() == ["category", "product_id"]
    with pytest.raises(TypeError):
        config.Config.of({"entities": [{"name": "x", "keys": [], "columns": [], "typo": 1}]})
    pytest.importorskip("yaml")
    (tmp_path / "c.yaml").write_text(json.dumps(SPEC))
    assert config.load(str(tmp_path / "c.yaml")) == c


def test_log_lines_are_json(caplog):
    run = runlog.RunContext(env="t").for_layer("silver")
    logger = logging.getLogger("lakeloom.test")
    with caplog.at_level(logging.INFO):
        runlog.log_event(logger, logging.INFO, "done", run, rows=3)
    line = json.loads(runlog.JsonFormatter().format(caplog.records[-1]))
    assert (line["message"], line["layer"], line["rows"], line["env"], line["master_run_id"]) == ("done", "silver", 3, "t", run.master_run_id)
