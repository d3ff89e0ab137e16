import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from visitlab.session import get_spark

    scratch = tempfile.mkdtemp(prefix="visitlab-test-")
    s = get_spark("local[4]", app="visitlab-tests", shuffle_partitions=4,
                  extra={"spark.checkpoint.dir": f"{scratch}/checkpoint",
                         "spark.local.dir": f"{scratch}/local",
                         "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


VISIT_SCHEMA = ("action_id long, date string, user_id long, session_id string, page_id long, "
                "action_time string, search_keyword string, click_category_id long, click_product_id long, "
                "order_category_ids string, order_product_ids string, pay_category_ids string, "
                "pay_product_ids string, city_id long")


def visit(action_id, session_id, action_time, user_id=1, page_id=0, kw=None, click_cat=None,
          click_prod=None, order_cats=None, pay_cats=None, city_id=0):
    return (action_id, action_time[:10], user_id, session_id, page_id, action_time, kw, click_cat,
            click_prod, order_cats, None if order_cats is None else "1", pay_cats,
            None if pay_cats is None else "1", city_id)


def rows(df, order=None):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
