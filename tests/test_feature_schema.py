"""Preparing features never brings a schema with a name per category to Python."""

import pytest
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql.classic.dataframe import DataFrame

from larch.plans import experiments as ex
from larch.plans import training as tr
from tests.conftest import SF001


@pytest.mark.parametrize("how", [{}, {"enable_categorical": True}])
def test_no_names_of_categories_in_python(spark, monkeypatch, how):
    seen, schema = [], DataFrame.schema

    def read(self):
        out = schema.func(self) if hasattr(schema, "func") else schema.fget(self)
        seen.append(out.json())
        return out

    monkeypatch.setattr(DataFrame, "schema", property(read))
    td = tr.prepare(spark, SF001, "classification", **how)
    if how:
        monkeypatch.setattr(StringIndexerModel, "labelsArray", property(lambda self: pytest.fail("labels came to Python")))
        assert max(ex.code_sizes(td)) == td.max_categories
    assert seen and not any('"attrs"' in x for x in seen)
    assert td.n_features == td.frame.first()["features"].size
    td.release()
