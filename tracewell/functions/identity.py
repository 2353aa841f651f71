"""Source identity: where a session ran, without credentials or local paths."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# --- fixed values --------------------------------------------------------------
OVERRIDE_KEYS = (
    "repo_identity",
    "repo_owner",
    "repo_name",
    "service_name",
    "project_slug",
    "environment",
    "observability_owner",
)
REMOTE_SCHEMES = "^(?i)(https?|ssh|git)://"
CONTROL = r"[\x00-\x1f\x7f]"


def first_line(text: Column) -> Column:
    lines = F.filter(
        F.transform(F.split(text, r"\r?\n"), lambda x: F.trim(x)), lambda x: x != ""
    )
    return F.get(lines, F.lit(0))


def safe_remote_path(path: Column) -> Column:
    """Path without leading slashes and ``.git``; null if any part of it is unsafe."""
    clean = F.regexp_replace(F.regexp_replace(path, "^/+", ""), r"(?i)\.git$", "")
    unsafe = F.exists(
        F.split(clean, "/"),
        lambda p: p.isin("", ".", "..") | p.rlike(CONTROL),
    )
    return F.when((clean != "") & ~F.contains(clean, F.lit("\\")) & ~unsafe, clean)


def sanitize_remote(remote: Column) -> Column:
    """(host, path) of a git remote address, both null unless it is safe to keep."""
    raw = first_line(remote)
    is_url = raw.rlike("^[A-Za-z][A-Za-z0-9+.-]*://")
    allowed = raw.rlike(REMOTE_SCHEMES)
    url_host = F.lower(
        F.regexp_extract(raw, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1)
    )
    url_path = F.regexp_extract(
        raw, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1
    )
    scp = r"^(?:[^@\s/:]+@)?([^:\s]+):(.+)$"
    scp_host = F.lower(F.regexp_extract(raw, scp, 1))
    scp_path = F.regexp_extract(raw, scp, 2)
    host = F.when(allowed, url_host).when(~is_url, scp_host)
    path = safe_remote_path(F.when(allowed, url_path).when(~is_url, scp_path))
    ok = (host != "") & path.isNotNull()
    return F.struct(
        F.when(ok, host).alias("git_remote_host"), F.when(ok, path).alias("git_remote_path")
    )


def repo_identity(path: Column) -> Column:
    """(identity, owner, name) from the last two parts of a remote path."""
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    owner = F.when(F.size(parts) >= 2, F.element_at(parts, -2))
    name = F.when(F.size(parts) >= 2, F.element_at(parts, -1))
    return F.struct(
        F.concat(owner, F.lit("/"), name).alias("repo_identity"),
        owner.alias("repo_owner"),
        name.alias("repo_name"),
    )


def safe_override(key: Column, value: Column) -> Column:
    """An override value that is short and is no path, address or control text."""
    text = F.trim(value)
    safe = (
        (text != "")
        & (F.length(text) <= 200)
        & ~text.rlike(CONTROL)
        & ~text.rlike(r"^([/\\~]|[A-Za-z]:[/\\])")
        & ~F.contains(text, F.lit("://"))
        & ~(key.isin("repo_owner", "repo_name") & text.rlike(r"[\\/]"))
        & ~((key == "repo_identity") & ~text.rlike(r"^[^/\\\s]+/[^/\\\s]+$"))
    )
    return F.when(key.isin(*OVERRIDE_KEYS) & safe, text)


def safe_overrides(overrides: Column) -> Column:
    return F.map_filter(
        F.transform_values(overrides, safe_override), lambda _, v: v.isNotNull()
    )


def git_commit(commit: Column) -> Column:
    return F.when(commit.rlike("^(?i)[0-9a-f]{40}$"), F.lower(commit))


def source_metadata(
    root_name: Column, branch: Column, commit: Column, remote: Column, overrides: Column
) -> Column:
    """One identity map: git facts, then the remote, then what derives from it, then
    the overrides; the later wins."""
    kept = safe_overrides(F.coalesce(overrides, F.create_map().cast("map<string,string>")))
    where = sanitize_remote(remote)
    who = repo_identity(where["git_remote_path"])
    facts = {
        "source_type": F.lit("git-repo"),
        "repo_root_name": root_name,
        "metadata_source": F.when(F.size(kept) > 0, F.lit("repo-file")).otherwise(
            F.lit("git-detection")
        ),
        "git_branch": F.nullif(branch, F.lit("")),
        "git_commit": git_commit(commit),
        "git_remote_host": where["git_remote_host"],
        "git_remote_path": where["git_remote_path"],
        "repo_identity": F.coalesce(
            kept["repo_identity"],
            who["repo_identity"],
            F.concat(kept["repo_owner"], F.lit("/"), kept["repo_name"]),
        ),
        "repo_owner": F.coalesce(kept["repo_owner"], who["repo_owner"]),
        "repo_name": F.coalesce(kept["repo_name"], who["repo_name"]),
        **{k: kept[k] for k in OVERRIDE_KEYS[3:]},
    }
    entries = [F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in facts.items()]
    return F.map_from_entries(F.filter(F.array(*entries), lambda e: e["value"].isNotNull()))


def non_git_metadata() -> Column:
    return F.create_map(
        F.lit("source_type"), F.lit("non-git"), F.lit("metadata_source"), F.lit("non-git")
    )


# --- session files ---------------------------------------------------------------
SESSIONS = "/sessions/"


def session_id(file: Column) -> Column:
    """Last path part without the first ``.jsonl``; empty for no file."""
    name = F.element_at(F.split(F.coalesce(file, F.lit("")), "/"), -1)
    return F.regexp_replace(name, r"^(.*?)\.jsonl", "$1")


def session_root(file: Column) -> Column:
    """Path through the first ``/sessions``, null without one."""
    at = F.instr(file, SESSIONS)
    return F.when(at > 0, file.substr(F.lit(1), at + len(SESSIONS) - 2))


def session_key(file: Column, id_: Column) -> Column:
    """Stable key of a session: its file, else its id; null is ambiguous."""
    return F.coalesce(
        F.concat(F.lit("file:"), F.nullif(file, F.lit(""))),
        F.concat(F.lit("id:"), F.nullif(id_, F.lit(""))),
    )


def raw_trace_path(file: Column) -> Column:
    """(project, session) folder and file under which a session's raw records go."""
    at = F.instr(file, SESSIONS)
    below = F.when(at > 0, file.substr(at + len(SESSIONS), F.length(file)))
    base = F.element_at(F.split(file, "/"), -1)
    nested = below.isNotNull() & F.contains(below, F.lit("/"))
    return F.when(
        file != "",
        F.struct(
            F.when(nested, F.regexp_extract(below, "^(.*)/[^/]*$", 1))
            .otherwise(F.lit("--unknown--"))
            .alias("project"),
            F.when(nested, F.element_at(F.split(below, "/"), -1))
            .otherwise(F.coalesce(below, base))
            .alias("session"),
        ),
    )
