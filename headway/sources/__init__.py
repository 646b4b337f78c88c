"""Sources: landing-zone readers, archive unpacking, derived test inputs."""
