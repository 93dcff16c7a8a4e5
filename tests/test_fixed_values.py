"""The values that must equal the source's, stated once more and by hand."""

from recurra import config


def test_rates():
    assert config.FX_TO_USD == {
        "USD": 1.0, "AUD": 0.68095, "NZD": 0.63136, "CAD": 0.7549, "GBP": 1.2727, "EUR": 1.10363, "DKK": 0.14801,
        "SGD": 0.75388, "FJD": 0.4531, "UAH": 0.02604, "AED": 0.2722, "SAR": 0.2612, "ZAR": 0.05455, "AOA": 0.0012,
        "MXN": 0.05893, "TRY": 0.0337, "MYR": 0.21751, "HRK": 0.1465,
    }


def test_limits_and_prices():
    assert (config.TERM_MONTHLY_MAX_DAYS, config.TERM_YEARLY_MAX_DAYS) == (31, 370)
    assert config.BATCH_TERM_MONTHS == {"YEARLY": 12, "MONTHLY": 1, "THREE YEAR": 36}
    assert (config.OVERRIDE_STAGE1_FACTOR, config.OVERRIDE_STAGE2_FACTOR) == (0.45, 0.7)
    assert (config.TRAINING_MULTI_USER_PRICE, config.TRAINING_SINGLE_USER_PRICE) == (149, 99)
    assert config.TRAINING_MULTI_USER_CURRENCIES == ("AUD", "USD") and config.TRAINING_SINGLE_USER_CURRENCIES == ("USD",)
    assert config.RENEWAL_TOLERANCE == 5 and config.UNMAPPED_PRODUCT == "Addon"
