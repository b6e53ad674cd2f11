"""A delivery that cannot be read as it stands is refused; what was loaded before stays."""

import pytest

from harborline.schemas import RAW_COLUMNS
from harborline.sources.landing import read_text_csv

COLUMNS = RAW_COLUMNS["utm_touches"]


@pytest.mark.parametrize("line", ["77,mail", "78,mail,spring,extra", '79,mail,"two\nlines"'])
def test_rows_of_another_width_are_refused(spark, tmp_path, line):
    good, bad = tmp_path / "good.csv", tmp_path / "bad.csv"
    good.write_text(",".join(COLUMNS) + "\n70,mail,spring\n71,,\n")
    bad.write_text(",".join(COLUMNS) + f"\n76,mail,spring\n{line}\n")
    rows = read_text_csv(spark, [str(good)], COLUMNS).collect()
    assert [(r["order_id"], r["utm_source"]) for r in rows] == [("70", "mail"), ("71", None)]
    with pytest.raises(Exception, match="(?i)malformed"):
        read_text_csv(spark, [str(bad)], COLUMNS).collect()
