import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from churnlab.session import get_spark
    s = get_spark("local[*]", app="churnlab-tests", shuffle_partitions=8)
    yield s
    s.stop()


# Two scoring presets of the original dashboard form (fixed test inputs).
PRESETS = {
    "high": dict(account_length=45, international_plan="Yes", voice_mail_plan="No", number_vmail_messages=0,
                 total_day_minutes=280.0, total_eve_minutes=220.0, total_night_minutes=200.0,
                 total_intl_minutes=15.0, total_day_calls=110, total_eve_calls=100, total_night_calls=95,
                 total_intl_calls=5, customer_service_calls=5),
    "low": dict(account_length=180, international_plan="No", voice_mail_plan="Yes", number_vmail_messages=25,
                total_day_minutes=150.0, total_eve_minutes=130.0, total_night_minutes=140.0,
                total_intl_minutes=8.0, total_day_calls=90, total_eve_calls=85, total_night_calls=80,
                total_intl_calls=3, customer_service_calls=1),
}
