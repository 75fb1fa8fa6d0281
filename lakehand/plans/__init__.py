"""Plans: control-table, monitoring and metadata jobs, plus derived test inputs."""
