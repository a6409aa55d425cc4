"""quirelake: a Spark-first engine that turns parsed documents into retrieval-ready tables."""

from quirelake.config import ChunkConfig, CitationConfig, EngineConfig, load_config
from quirelake.session import get_session

__all__ = ["ChunkConfig", "CitationConfig", "EngineConfig", "get_session", "load_config"]
__version__ = "0.1.0"
