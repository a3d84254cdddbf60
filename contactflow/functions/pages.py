"""Fields of stored answer pages, read by a tag scanner with the nesting of a browser's tree."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Ids and classes of the answer page.
PHONE_ID, MAIL_ID, ALERT_CLASSES = "telefono", "correoElectronico", {"alerta", "error"}
#: Elements without content, which have no end tag.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Elements whose content is no text of the page.
HIDDEN = {"script", "style", "template"}

FIELDS = "struct<fone: string, email: string, alerta: string>"


class _Scanner(HTMLParser):
    """First elements with the two ids, and the text of the first alert with all that is nested in it."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.values: dict[str, str] = {}
        self.open: list[str] = []
        self.alert: list[str] | None = None
        #: How many elements are open around the alert, while it is open.
        self.outside: int | None = None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        held = {name: value or "" for name, value in attrs}  # of repeated attributes the last one counts
        name = held.get("id")
        if name in (PHONE_ID, MAIL_ID):
            self.values.setdefault(name, held.get("value", ""))
        if self.alert is None and set(held.get("class", "").split()) >= ALERT_CLASSES:
            self.alert = []
            self.outside = None if tag in VOID else len(self.open)
        if tag not in VOID:
            self.open.append(tag)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag not in self.open or tag in VOID:
            return  # an end without a start
        while self.open.pop() != tag:  # what was left open ends with it
            pass
        if self.outside is not None and len(self.open) <= self.outside:
            self.outside = None

    def handle_data(self, data: str) -> None:
        if self.outside is not None and not HIDDEN.intersection(self.open[self.outside :]):
            self.alert.append(data)


def page_fields(body: str | None) -> dict[str, str | None]:
    """Values of the two inputs, null without the element, and the text of the alert, null without one."""
    scanner = _Scanner()
    if body:
        scanner.feed(body)
        scanner.close()
    alert = None if scanner.alert is None else "".join(scanner.alert).strip()
    return {"fone": scanner.values.get(PHONE_ID), "email": scanner.values.get(MAIL_ID), "alerta": alert}


def scanned(body: Column) -> Column:
    """Struct (fone, email, alerta) of a page; null and empty pages have nothing. One Arrow batch at a time."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.struct([("fone", pa.string()), ("email", pa.string()), ("alerta", pa.string())])
        for bodies in batches:
            yield pa.array([page_fields(b) for b in bodies.to_pylist()], kind)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, FIELDS)(body)
