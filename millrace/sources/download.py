"""Resumable download and verification; runs on the driver."""

from __future__ import annotations

import hashlib
import time
import urllib.error
import urllib.request
from collections.abc import Callable
from pathlib import Path


def file_sha256(path: str | Path, block: int = 1 << 20) -> str:
    h = hashlib.sha256()
    with open(path, "rb") as f:
        while data := f.read(block):
            h.update(data)
    return h.hexdigest()


def verify(path: str | Path, sha256: str | None = None, size: int | None = None) -> None:
    """FileNotFoundError where there is no file, ValueError where its size or hash is another; empty expectations are skipped."""
    p = Path(path)
    if not p.exists():
        raise FileNotFoundError(p)
    if size is not None and p.stat().st_size != size:
        raise ValueError(f"{p} has {p.stat().st_size} bytes, not {size}")
    want = (sha256 or "").strip().lower()
    if want and file_sha256(p) != want:
        raise ValueError(f"{p} has another SHA-256 than {want}")


def download(url: str, path: str | Path, retries: int = 3, backoff: float = 5, timeout: float = 30, overwrite: bool = False, sha256: str | None = None, size: int | None = None, sleep: Callable[[float], None] = time.sleep) -> Path:
    """Fetches url, going on where an earlier try ended, and verifies what it fetched. A file that already meets the expectations isn't requested again."""
    p = Path(path)
    p.parent.mkdir(parents=True, exist_ok=True)
    if overwrite:
        p.unlink(missing_ok=True)
    elif p.exists() and (sha256 or size is not None):
        try:
            verify(p, sha256, size)
            return p
        except ValueError:
            pass
    for attempt in range(1, retries + 1):
        have = p.stat().st_size if p.exists() else 0
        request = urllib.request.Request(url, headers={"Range": f"bytes={have}-"} if have else {})
        try:
            with urllib.request.urlopen(request, timeout=timeout) as response, open(p, "ab" if have and response.status == 206 else "wb") as f:
                while data := response.read(1 << 20):
                    f.write(data)
            verify(p, sha256, size)
            return p
        except urllib.error.HTTPError as e:
            if e.code == 416 and have:  # nothing is left to fetch
                verify(p, sha256, size)
                return p
            if attempt == retries:
                raise
        except OSError:
            if attempt == retries:
                raise
        sleep(backoff * attempt)
    raise ValueError("retries must be 1 or more")
