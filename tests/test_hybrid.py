"""Tables that the hybrid model's features write on the way."""

from pyspark.sql import functions as F

from fraudlens.plans import training
from fraudlens.queries import base
from fraudlens.session import settle

SF = "/root/testdata/sf0.001"


def test_vectors_are_not_written_on_the_way(spark, monkeypatch):
    """Risks are joined to narrow rows; the rows with all their vectors are left for the caller to write."""
    named = base.split_txn(spark, SF).withColumns({"DeviceType": F.lit("d"), "DeviceInfo_simple": F.lit("i"), "card3": F.col("card2")})
    rows = settle(named)
    written = {}

    def noted(df, label="table", by=None):
        written[label] = df.columns
        return settle(df, label, by)

    monkeypatch.setattr(training, "settle", noted)
    made = training.hybrid_features(rows, base.ORDER, hops=1)
    assert not [label for label, columns in written.items() if "features" in columns]
    assert written["edges"] == ["src", "dst"] and set(written["risks"]) == {*rows.columns, "_risk_card", "_risk_email", "_risk_device"}
    assert set(made.columns) == {*rows.columns, "features"} and made.count() == rows.count()
