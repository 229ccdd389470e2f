"""Hand-made register pulls (invented rows; schemas as in FIXTURES.md)."""

import json
import os

D1 = "2023-01-01T00:00:00+03:00"
D2 = "2023-01-02T00:00:00+03:00"
D5 = "2023-01-05T00:00:00+03:00"

PULL1 = {
    "short_info": [
        {"ngrn": 100, "dfrom": D1, "vfio": "О'Нил А.", "vnaim": None,
         "nsi00219": {"vnsostk": "Действующий", "nk": 1}},
        {"ngrn": 100, "dfrom": D2, "vfio": None, "vnaim": "Другое",
         "nsi00219": {"vnsostk": "Закрыт"}},
        {"ngrn": 101, "dfrom": D2, "vfio": None, "vnaim": 'ООО "А, Б"'},
        {"ngrn": 102, "dfrom": D2, "vfio": None, "vnaim": None,
         "nsi00219": {"vnsostk": "Действующий"}},
    ],
    "contact_info": [
        {"ngrn": 100, "dfrom": D1, "vregion": "Минск", "vdistrict": None, "vnp": "Минск",
         "nsi00202": {"vnsfull": "ул. Мира, 5", "z": 1}, "vemail": None, "vtels": "1"},
        {"ngrn": 101, "dfrom": D1, "vregion": None, "vdistrict": None, "vnp": None,
         "nsi00202": {"vnsfull": "Брест"}, "vemail": "a@b", "vtels": None},
    ],
    "okved_info": [
        {"ngrn": 100, "dfrom": D1, "nsi00114": {"vkvdn": 62010, "vnvdnp": "Торговля, прочая"}},
        {"ngrn": 100, "dfrom": D1, "nsi00114": {"vkvdn": "47110", "vnvdnp": "Иное"}},
    ],
}

PULL2 = {
    "short_info": [
        {"ngrn": 100, "dfrom": D5, "vfio": "О'Нил А.", "nsi00219": {"vnsostk": "Закрыт"}},
        {"ngrn": 103, "dfrom": D5, "vnaim": "Новая", "nsi00219": {"vnsostk": "Действующий"}},
    ],
    "contact_info": [
        {"ngrn": 100, "dfrom": D5, "vregion": "Минск", "vdistrict": None, "vnp": "Минск",
         "nsi00202": {"vnsfull": "Новый адрес"}, "vemail": None, "vtels": "1"},
    ],
    "okved_info": [],
}


def land(root, pull, day):
    """Write one pull as JSON-array files: <root>/<kind>/load_date=<day>/feed.json."""
    for kind, rows in pull.items():
        d = os.path.join(root, kind, f"load_date={day}")
        os.makedirs(d, exist_ok=True)
        with open(os.path.join(d, "feed.json"), "w", encoding="utf-8") as f:
            json.dump(rows, f, ensure_ascii=False)
    return root
