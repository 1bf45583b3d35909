"""Stage compositions: operators joined up from source to sink."""
