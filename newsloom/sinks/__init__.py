"""Writers and keyed loads."""
