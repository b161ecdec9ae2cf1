"""A service that makes TEI of PDF files: its requests, whether it is there, whether it can read scans."""

from __future__ import annotations

import time
import urllib.error
import urllib.request
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from corpusloom.sources.services import Limiter, ServiceError

#: Seconds between two requests, and that a conversion and a probe may take.
INTERVAL, TIMEOUT, PROBE = 1.0, 300.0, 5.0
# Paths of the service, and what tells in its answers that it has an engine for scans.
FULL, HEADER, ALIVE, VERSION, PROPERTIES = "/api/processFulltextDocument", "/api/processHeaderDocument", "/api/isalive", "/api/version", "/service/properties"
OCR_VERSION, OCR_PROPERTIES = ("full",), ("tesseract", "ocr=true", "ocr.enabled=true", "pdfalto.ocr=")


def reads_scans(version: str | None, properties: str | None) -> bool:
    """Whether a service can read scanned pages, by what it tells of itself; what tells nothing can't."""
    if version is None:
        return False
    return any(w in version.lower() for w in OCR_VERSION) or any(w in (properties or "").lower() for w in OCR_PROPERTIES)


def form(data: bytes, fields: dict[str, str]) -> tuple[bytes, str]:
    """A file and fields as the body of a form, and its content type."""
    mark = uuid.uuid4().hex
    parts = [f'--{mark}\r\nContent-Disposition: form-data; name="{k}"\r\n\r\n{v}\r\n'.encode() for k, v in fields.items()]
    head = f'--{mark}\r\nContent-Disposition: form-data; name="input"; filename="document.pdf"\r\nContent-Type: application/pdf\r\n\r\n'.encode()
    return b"".join([*parts, head, data, f"\r\n--{mark}--\r\n".encode()]), f"multipart/form-data; boundary={mark}"


@dataclass
class TeiService:
    """``service(bytes, full)`` is the TEI of a PDF file, of its whole text or its header, or None where it can't be made.
    Tasks can take it along; each has its share of the rate."""

    url: str = "http://localhost:8070"
    ocr: bool = False
    timeout: float = TIMEOUT
    open: Callable = urllib.request.urlopen
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep
    readers: int = 1
    reader: int = 0
    limiter: Limiter | None = field(default=None, repr=False)

    def shared(self, readers: int, reader: int) -> TeiService:
        return replace(self, readers=readers, reader=reader, limiter=None)

    def _told(self, path: str) -> str | None:
        try:
            with self.open(urllib.request.Request(self.url.rstrip("/") + path), timeout=PROBE) as r:
                return r.read().decode("utf-8", "replace")
        except OSError:
            return None

    def available(self) -> bool:
        return self._told(ALIVE) is not None

    def has_ocr(self) -> bool:
        version = self._told(VERSION)
        return reads_scans(version, self._told(PROPERTIES) if version is not None else None)

    def checked(self) -> TeiService:
        """Itself, where it is there and can do what is asked; else an error that says why not."""
        if not self.available():
            raise ServiceError("tei", f"no service at {self.url}")
        if self.ocr and not self.has_ocr():
            raise ServiceError("tei", f"the service at {self.url} can't read scans")
        return self

    def __call__(self, data: bytes, full: bool) -> str | None:
        self.limiter = self.limiter or Limiter(INTERVAL * self.readers, self.clock, self.sleep, INTERVAL * (self.reader + 1) if self.readers > 1 else 0.0)
        self.limiter.wait()
        body, kind = form(data, {"consolidateHeader": "1"} | ({"ocr": "true"} if self.ocr else {}))
        request = urllib.request.Request(self.url.rstrip("/") + (FULL if full else HEADER), body, {"Content-Type": kind})
        try:
            with self.open(request, timeout=self.timeout) as r:
                return r.read().decode("utf-8", "replace") if r.status == 200 else None
        except OSError:  # of which HTTP errors are a kind
            return None
