"""Process set-up for command-line runs: environment file, logging, seeds and tagged output folders."""

from __future__ import annotations

import logging
import os
import random
import warnings
from pathlib import Path

import numpy as np


def load_env(path: str | Path = ".env") -> dict[str, str]:
    """KEY=value lines of a file go to the environment, where they aren't set already; returns what was set."""
    p, put = Path(path), {}
    for line in p.read_text(encoding="utf-8").splitlines() if p.exists() else ():
        key, found, value = line.strip().removeprefix("export ").partition("=")
        if found and not key.startswith("#") and key.strip() not in os.environ:
            put[key.strip()] = value.strip().strip("'\"")
    os.environ.update(put)
    return put


def set_seed(seed: int) -> None:
    """For Python's and numpy's generators; operators take theirs from hashes of the data and need none."""
    random.seed(seed)
    np.random.seed(seed % 2**32)
    os.environ["PYTHONHASHSEED"] = str(seed)


def tagged_folder(base: str, tag: object = None) -> str:
    """base, or a folder below it where there is a tag that isn't blank."""
    name = "" if tag is None else str(tag).strip()
    return os.path.join(base, name) if name else base


def configure_environment(env_file: str | None = ".env", level: str | None = None, quiet: tuple[str, ...] = ("py4j", "httpx"), seed: int | None = None) -> logging.Logger:
    """Reads the environment file, sets up logging (LOG_LEVEL by default) and the seed; returns the engine's logger."""
    if env_file:
        load_env(env_file)
    warnings.simplefilter("ignore", FutureWarning)
    logging.captureWarnings(True)
    logging.basicConfig(level=(level or os.environ.get("LOG_LEVEL", "INFO")).upper(), format="%(asctime)s %(name)s %(levelname)s %(message)s")
    for name in quiet:
        logging.getLogger(name).setLevel(logging.WARNING)
    if seed is not None:
        set_seed(seed)
    return logging.getLogger("millrace")
