"""Raw files for a run: from a local path, a cache with a time to live, or HTTP with conditional requests. Driver only."""

from __future__ import annotations

import hashlib
import http.client
import json
import shutil
import time
import urllib.parse
from pathlib import Path

from quillmere.plans.contexts import IngestRun
from quillmere.plans.errors import FetchError

USER_AGENT, CHUNK, DEFAULT_TTL = "quillmere/0.2", 65536, 86400
#: Seconds for a connection to be made, and for each answer on it; redirects that are followed.
CONNECT, READ, REDIRECTS = 10, 120, 10


def cache_path(folder: Path, url: str, ext: str) -> Path:
    return Path(folder) / f"{hashlib.sha256(url.encode()).hexdigest()[:16]}.{ext}"


def meta_path(file: Path) -> Path:
    return file.with_name(file.name + ".meta.json")


def read_meta(file: Path) -> dict | None:
    p = meta_path(file)
    return json.loads(p.read_text(encoding="utf-8")) if p.exists() else None


def write_meta(file: Path, meta: dict) -> None:
    meta_path(file).write_text(json.dumps(meta, indent=2), encoding="utf-8")


def is_fresh(file: Path, ttl_seconds: int, now: float | None = None) -> bool:
    """The file and its meta are there, and less than the time to live has passed."""
    meta = read_meta(file) if file.exists() else None
    return bool(meta) and (time.time() if now is None else now) - float(meta.get("retrieved_at", 0)) < ttl_seconds


def sha256_file(path: Path) -> str:
    h = hashlib.sha256()
    with open(path, "rb") as f:
        while part := f.read(CHUNK):
            h.update(part)
    return h.hexdigest()


def _stamp(at: float) -> str:
    return time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime(at))


def http_get(url: str, headers: dict[str, str], to: Path) -> tuple[int, dict]:
    """(status, headers); any status is an answer. The body of a 200 is streamed to the file `to`."""
    try:
        for _ in range(REDIRECTS):
            at = urllib.parse.urlsplit(url)
            kind = http.client.HTTPSConnection if at.scheme == "https" else http.client.HTTPConnection
            link = kind(at.hostname, at.port, timeout=CONNECT)
            try:
                link.connect()
                link.sock.settimeout(READ)
                link.request("GET", urllib.parse.urlunsplit(("", "", at.path or "/", at.query, "")), headers=headers)
                r = link.getresponse()
                if r.status in (301, 302, 303, 307, 308) and r.getheader("Location"):
                    url = urllib.parse.urljoin(url, r.getheader("Location"))
                    continue
                if r.status == 200:
                    with open(to, "wb") as f:
                        shutil.copyfileobj(r, f, CHUNK)
                return r.status, dict(r.headers)
            finally:
                link.close()
    except (OSError, http.client.HTTPException) as e:
        raise FetchError(f"GET {url} failed: {e}") from e
    raise FetchError(f"GET {url}: more than {REDIRECTS} redirects")


def fetch_raw(run: IngestRun, config: dict, get=http_get) -> tuple[Path, dict]:
    """(the run's own copy of the raw file, what the manifest says of it).

    refresh skips the look at the time to live but still asks conditionally; an answer of 304 serves the
    cached file and leaves its age as it was.
    """
    ext = "xml" if config.get("format") == "xml" else "csv"
    url, copy = config["url"], run.raw / config.get("raw_filename", f"source.{ext}")
    cached = cache_path(run.cache, url, ext)
    for folder in (run.cache, run.raw):
        folder.mkdir(parents=True, exist_ok=True)
    policy = run.fetch_policy
    if config.get("local_only") and policy != "local-file":
        raise FetchError(f"{run.source} comes from a local file: use the policy local-file and give an input")
    if policy == "local-file":
        if run.input_path is None:
            raise FetchError("the policy local-file needs an input")
        shutil.copy2(run.input_path, copy)
        return copy, {"url": str(run.input_path), "fetch_policy": policy, "cache_hit": False, "sha256": sha256_file(copy), "bytes": copy.stat().st_size, "retrieved_at": _stamp(time.time())}

    def from_cache() -> tuple[Path, dict]:
        shutil.copy2(cached, copy)
        return copy, (read_meta(cached) or {}) | {"cache_hit": True, "fetch_policy": policy}

    if policy == "cache-only":
        if not cached.exists():
            raise FetchError(f"nothing cached for {run.source}")
        return from_cache()
    if policy == "default" and is_fresh(cached, int(config.get("ttl_seconds", DEFAULT_TTL))):
        return from_cache()
    known = read_meta(cached) or {}
    asked = {"User-Agent": USER_AGENT} | {h: known[k] for h, k in (("If-None-Match", "etag"), ("If-Modified-Since", "last_modified")) if known.get(k)}
    fresh = cached.with_name(cached.name + ".new")
    status, headers = get(url, asked, fresh)
    if status == 304 and cached.exists():
        return from_cache()
    if status != 200:
        raise FetchError(f"GET {url} returned {status}")
    fresh.replace(cached)
    shutil.copyfile(cached, copy)
    told = {k.lower(): v for k, v in headers.items()}
    meta = {"url": url, "fetch_policy": policy, "cache_hit": False, "etag": told.get("etag"), "last_modified": told.get("last-modified"), "sha256": sha256_file(cached), "bytes": cached.stat().st_size, "retrieved_at": time.time()}
    write_meta(cached, meta)
    return copy, meta | {"retrieved_at": _stamp(meta["retrieved_at"])}
