from inspecta.functions.columns import (  # noqa: F401
    as_of_col, last_test, last_test_date, last_test_result, to_mileage,
    vehicle_age, count_results, feed_date_from_path, feed_date_string,
    pass_probability,
)
from inspecta.functions.calendar import gb_holidays  # noqa: F401
