"""What the tests share besides fixtures; a name of its own, since every test folder may have a conftest."""

SF_SMALL = "/root/testdata/sf0.001"


def local_path(path: str) -> str:
    """Plain local path of a scratch location (tests only inspect local folders)."""
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    return path
