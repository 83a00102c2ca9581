"""Message streams: encode, decode, replay, deliver, count and group by minute, follow positions."""

from tidemark.streaming.compaction import compact_minutes, minute_file_counts, read_compacted_minutes
from tidemark.streaming.counting import add_minute_counts, read_minute_counts, write_minute_counts
from tidemark.streaming.delivery import acknowledged, rejected_records, sent_batches, start_acknowledged
from tidemark.streaming.messages import decode_messages, encode_messages, read_message_files
from tidemark.streaming.minutes import minute_counts, read_minute_files, write_minute_files
from tidemark.streaming.pacing import PacedReplay, folder_sender, messages_per_step, number_rows, replay_paced, topic_sender
from tidemark.streaming.progress import PositionLog, await_positions, read_positions
from tidemark.streaming.replay import read_tweet_stream, replay, split_for_replay, start_replay, text_sink

__all__ = [
    "PacedReplay",
    "PositionLog",
    "acknowledged",
    "add_minute_counts",
    "await_positions",
    "compact_minutes",
    "decode_messages",
    "encode_messages",
    "folder_sender",
    "messages_per_step",
    "minute_counts",
    "minute_file_counts",
    "number_rows",
    "read_compacted_minutes",
    "read_message_files",
    "read_minute_counts",
    "read_minute_files",
    "read_positions",
    "read_tweet_stream",
    "rejected_records",
    "replay",
    "replay_paced",
    "sent_batches",
    "split_for_replay",
    "start_acknowledged",
    "start_replay",
    "text_sink",
    "topic_sender",
    "write_minute_counts",
    "write_minute_files",
]
