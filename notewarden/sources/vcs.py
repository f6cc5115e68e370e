"""A hook for after a note is written: keeps it in the git repository around it, if there is one.

Runs on the driver, once for each command line call; it never stops a run and has no part in any dataflow."""

from __future__ import annotations

import os
import subprocess

TIMEOUT = 10


def _git(folder: str, *args: str) -> str | None:
    """The output of a git command, None where it fails or takes too long."""
    try:
        done = subprocess.run(["git", "-C", folder, *args], capture_output=True, text=True, timeout=TIMEOUT, check=True)
    except (OSError, subprocess.SubprocessError):
        return None
    return done.stdout.strip()


def in_repository(folder: str) -> bool:
    return _git(folder, "rev-parse", "--is-inside-work-tree") == "true"


def commit_file(path: str, message: str) -> bool:
    """Commits one file; false without a repository or a change."""
    folder, name = os.path.split(os.path.abspath(path))
    return in_repository(folder) and _git(folder, "add", "--", name) is not None and _git(folder, "commit", "-q", "-m", message, "--", name) is not None


def create_branch(folder: str, name: str) -> bool:
    return in_repository(folder) and _git(folder, "checkout", "-q", "-b", name) is not None


def diff_summary(folder: str, since: str = "HEAD") -> str:
    return _git(folder, "diff", "--stat", since) or ""
