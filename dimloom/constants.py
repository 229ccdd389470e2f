"""Fixed values.

These must equal the values used by the system we reproduce, otherwise
results differ. They are stated once, plainly, here.
"""

# --- fixed values -----------------------------------------------------------
# Fill value for a missing text field ("no").
NONE_TEXT = "Нет"
# Option that disables a filter parameter ("all").
ALL_OPTION = "Все"
# org_type when a personal name (vfio) is present: individual entrepreneur.
TYPE_PERSON = "ИП"
# org_type otherwise: legal entity.
TYPE_COMPANY = "ЮЛ"
# Seed row of every watermark table.
WATERMARK_SEED = "1991-01-01 00:00:00"
# Text form of the period bounds of a pull.
PERIOD_FORMAT = "dd.MM.yyyy"
# The three feed kinds, in pull order.
FEED_KINDS = ("short_info", "contact_info", "okved_info")
# Nested object and field read from each feed.
#   short_info:   nsi00219.vnsostk -> status
#   contact_info: nsi00202.vnsfull -> location
#   okved_info:   nsi00114.vkvdn   -> okved_code, nsi00114.vnvdnp -> okved_text
# varchar(n) limits of the warehouse columns.
LENGTH_LIMITS = {
    "org_type": 2,
    "okved_code": 10,
    "region": 20,
    "vregion": 20,
    "district": 30,
    "vdistrict": 30,
}
# ---------------------------------------------------------------------------

# Columns the mart upsert overwrites on a key match; every other column keeps
# the value of the first insert.
MART_UPDATE_COLS = ("date", "status", "okved_code", "okved_text")
MART_KEYS = ("org_name", "ngrn")
