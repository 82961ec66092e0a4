import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from doctext.session import get_spark
    yield get_spark("local[4]", shuffle_partitions=4,
                    extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="doctext-test-")})


@pytest.fixture(scope="session")
def catalog(spark):
    from doctext.sources.tables import Catalog
    return Catalog(spark, SF)
